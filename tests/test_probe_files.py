"""Looking for frequent keys leaves no shuffle files behind: the probe may be as large as the join itself."""

from tiers.operators.joins import Probe, hot_keys


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return sum(1 for i in range(blocks.size()) if blocks.apply(i).isShuffle())


def test_probes_drop_their_shuffles(spark):
    rows = spark.range(5000).selectExpr("id % 300 k", "id v").repartition(4, "v").dropDuplicates(["v"])
    before = shuffle_files(spark)
    assert Probe(rows, ["k"]).frequent(["k"])
    assert hot_keys([], [rows], ["k"], "left", 10)
    assert shuffle_files(spark) <= before
