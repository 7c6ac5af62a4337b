"""Mixing sources to target weights as a min-cost flow.

Documents are summed up by the set of sources they belong to (their pattern). Words flow from patterns to the sources of
the pattern, up to each source's target; a pattern can be used up to three times, and each further use costs more (1, 3,
5), so repetition is spread as thin as the targets allow. The flow graph has a node per pattern and source, not per
document. What a pattern sends is then taken from its documents: so many whole rounds over all of them, and for the rest
the documents with the least seeded hash, found by prefix sums over hash buckets; the document on the edge is cut.
"""

from __future__ import annotations

import json
import math
from collections import defaultdict, deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tiers.llm.common import free, keep, own

#: Sets of sources that may occur; one row for each reaches the driver and the executors.
MAX_PATTERNS = 100_000
#: Uses of a document, and what each costs a word.
COSTS = (1, 3, 5)
SEED = 20
WORD = "[^\\x20\\x09-\\x0D]+"


def targets(sizes: dict[str | None, int], most: int = 3) -> dict[str | None, float]:
    """All words shared out by weights 1, 2, 3, 1, ... in code point order, None last; none above `most` times its size."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    out: dict[str | None, float] = {}
    left = float(sum(sizes.values()))
    while weight:
        whole = sum(weight.values())
        share = {s: left * w / whole for s, w in weight.items()}
        over = [s for s in share if share[s] > most * sizes[s]]
        if not over:
            return out | share
        for s in over:
            out[s] = float(most * sizes[s])
            left -= out[s]
            del weight[s]
    return out


def flow(capacity: list[int], members: list[list[str | None]], quota: dict[str | None, int]) -> list[int]:
    """Words each pattern sends: as many as quotas allow, at least cost. Parts of the graph without a tie are solved apart."""
    of: dict[str | None, list[int]] = defaultdict(list)
    for p, sources in enumerate(members):
        for s in sources:
            of[s].append(p)
    sent, done = [0] * len(capacity), set()
    for start in range(len(capacity)):
        if start in done:
            continue
        part, todo = {start}, [start]
        while todo:
            for s in members[todo.pop()]:
                new = [p for p in of[s] if p not in part]
                part.update(new)
                todo += new
        done |= part
        for p, n in _cheapest(sorted(part), capacity, members, quota).items():
            sent[p] = n
    return sent


def _cheapest(part: list[int], capacity: list[int], members: list[list[str | None]], quota: dict[str | None, int]) -> dict[int, int]:
    """Successive cheapest paths through start, patterns, sources, end."""
    graph: dict = defaultdict(list)  # node: [to, room, cost, index of the way back]

    def arc(a, b, room, cost):
        graph[a].append([b, room, cost, len(graph[b])])
        graph[b].append([a, 0, -cost, len(graph[a]) - 1])

    for p in part:
        for cost in COSTS:
            arc("start", ("p", p), capacity[p], cost)
        for s in members[p]:
            arc(("p", p), ("s", s), len(COSTS) * capacity[p], 0)
    for s in {s for p in part for s in members[p]}:
        arc(("s", s), "end", quota[s], 0)
    while True:
        far, way, queue = {"start": 0}, {}, deque(["start"])
        while queue:
            a = queue.popleft()
            for i, (b, room, cost, _) in enumerate(graph[a]):
                if room > 0 and far[a] + cost < far.get(b, math.inf):
                    far[b], way[b] = far[a] + cost, (a, i)
                    queue.append(b)
        if "end" not in far:
            break
        path, node = [], "end"
        while node != "start":
            path.append(way[node])
            node = way[node][0]
        room = min(graph[a][i][1] for a, i in path)
        for a, i in path:
            graph[a][i][1] -= room
            b, _, _, back = graph[a][i]
            graph[b][back][1] += room
    sent = dict.fromkeys(part, 0)
    for b, room, cost, back in graph["start"]:
        if cost > 0:
            sent[b[1]] += graph[b][back][1]
    return sent


def sized(docs: DataFrame, sources: Column | None = None) -> DataFrame:
    """The documents with `size` (words; NULL text: 0) and `pattern` (their sources as JSON)."""
    of = F.array("source") if sources is None else F.array_sort(F.array_distinct(sources))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.drop("size", "pattern").withColumns({"size": size, "pattern": F.to_json(F.struct(of.alias("of")), {"ignoreNullFields": "false"})})


def plan(narrow: DataFrame, seed: int) -> DataFrame:
    """A row per pattern: source_size and target of its first source, whole rounds, and where the rest ends."""
    spark = narrow.sparkSession
    rows = narrow.groupBy("pattern").agg(F.sum("size").alias("words"), F.count("*").alias("n")).limit(MAX_PATTERNS + 1).collect()
    if len(rows) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} sets of sources")
    rows = sorted(rows, key=lambda r: r["pattern"])
    members = [json.loads(r["pattern"])["of"] for r in rows]
    capacity = [r["words"] for r in rows]
    sizes: dict[str | None, int] = defaultdict(int)
    for of, n in zip(members, capacity, strict=True):
        for s in of:
            sizes[s] += n
    goal = targets(sizes)
    # An overlap counts for each of its sources, so that their sizes may add up to more than there is.
    sent = flow(capacity, members, {s: min(round(t), len(COSTS) * sizes[s]) for s, t in goal.items()})
    known = []
    for r, of, n in zip(rows, members, sent, strict=True):
        rounds, rest = divmod(n, r["words"]) if r["words"] else (0, 0)
        first = of[0] if of else None
        known.append((r["pattern"], sizes.get(first, 0), float(goal.get(first, 0)), rounds, rest, max(1, math.isqrt(r["n"]))))
    fields = "pattern string, source_size long, target double, rounds long, rest long, buckets long"
    table = spark.createDataFrame(known, fields)
    sums = dealt(narrow, table, seed).where("rest > 0").groupBy("pattern", "rest", "bucket").agg(F.sum("size").alias("words"))
    run = F.sum("words").over(Window.partitionBy("pattern").orderBy("bucket"))
    edge = sums.withColumn("upto", run).where("upto >= rest").groupBy("pattern")
    edges = edge.agg(F.min("bucket").alias("edge"), F.min_by(F.col("upto") - F.col("words"), "bucket").alias("ahead"))
    at = {r["pattern"]: (r["edge"], r["ahead"]) for r in edges.collect()}
    return spark.createDataFrame([(*k, *at.get(k[0], (-1, 0))) for k in known], fields + ", edge long, ahead long")


def dealt(docs: DataFrame, table: DataFrame, seed: int) -> DataFrame:
    """Documents with their pattern's plan, at most MAX_PATTERNS rows, and their bucket by seeded hash."""
    hashed = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    both = docs.join(F.broadcast(table), "pattern")
    return both.withColumn("order", hashed).withColumn("bucket", F.pmod("order", "buckets"))


def select(docs: DataFrame, table: DataFrame, seed: int) -> DataFrame:
    """`taken` words of each document; only the bucket on the edge of each pattern is sorted, some root of its documents."""
    rows = dealt(docs, table, seed)
    whole = F.col("rounds") * F.col("size")
    apart = rows.where(F.col("bucket") != F.col("edge")).withColumn("taken", whole + F.when(F.col("bucket") < F.col("edge"), F.col("size")).otherwise(F.lit(0)))
    before = Window.partitionBy("pattern").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("rest") - F.col("ahead") - F.coalesce(F.sum("size").over(before), F.lit(0))
    part = F.greatest(F.lit(0).cast("long"), F.least("size", left))
    edge = rows.where(F.col("bucket") == F.col("edge")).withColumn("taken", whole + part)
    return apart.unionByName(edge).drop("pattern", "rounds", "rest", "buckets", "edge", "ahead", "order", "bucket")


def mixed(docs: DataFrame, sources: Column | None = None, seed: int = SEED, texts: bool = False) -> DataFrame:
    """Every document with size, source_size, target and taken: the words the mix takes of it, repeats counted.

    Sizes count runs of non-space characters. Sources are those in `sources` (an array; as a rule the one in `source`, NULL
    being a source too); size and target are of the first. Taken words of a source come to its target, rounded; at most one
    document a pattern is cut. A NULL or empty text is never taken; equal rows may differ in `taken` where the edge
    runs between them. With `texts` all columns are returned, but for those called like one of the four
    results, else doc_id only.
    """
    narrow = keep(sized(docs, sources).select("doc_id", "size", "pattern"), "mix")
    table = plan(narrow, seed)
    if not texts:
        return select(narrow, table, seed)
    # Rows pass through as one column each, so that none of theirs can be taken for one of the plan.
    whole = sized(docs.withColumn(free(docs, "row"), F.struct(*own(docs))), sources)
    row = F.col(free(docs, "row")).alias("row")
    found = select(whole.select("doc_id", "size", "pattern", row), table, seed)
    results = ["size", "source_size", "target", "taken"]
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() not in results]
    return found.select(*kept, *results)
