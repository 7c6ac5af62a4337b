"""Embedding near-duplicates by a robust-pruned flat graph.

1. Vectors are scaled to length 1 and exact copies become one node with a count.
2. A bounded sample of nodes serves as centres. Each node belongs to the shard of its nearest centre and, so that shards
   overlap, to those of all centres nearly as near. A shard beyond `BLOCK` nodes is cut into blocks by hash.
3. In each block a graph is built: a node's nearest neighbours, robust-pruned, a few far ones, and the edges back. The
   adjacency lists of a node from all its blocks are united.
4. Each node is searched for in all blocks of its own shard, over the united lists: a greedy beam from the block's medoids
   (and the node itself where the block holds it) until it is near, then an expansion through all nodes in range and
   slightly beyond. Cosines are computed in double precision, so that every link reported is one.
5. A block reports how many vectors each node links to and a spanning forest of the links, not the links themselves;
   components are joined from the forests.

`audit` measures the recall of links against brute force for every hundredth vector.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiers.llm.common import components, keep, mix

COSINE = 0.98
#: Nodes a shard aims at and a block may hold; centres in all; how much farther than the nearest a further centre may be.
SHARD, BLOCK, CENTRES, MARGIN = 2000, 3000, 8192, 0.1
#: Neighbours considered, kept after pruning, far ones, all with the edges back; the pruning's slack; the beam's width.
CANDIDATES, DEGREE, FAR, MOST, ALPHA, BEAM = 40, 20, 4, 48, 1.2, 16
#: Nodes this far below the threshold still lead on.
SLACK = 0.06
MEDOIDS = 8


def units(vectors: DataFrame) -> DataFrame:
    """vec_id, group (label and dimension), v (unit vector as bytes); the last two are NULL where nothing can be linked."""

    def unit(x: list | None) -> bytes | None:
        v = np.array([np.nan if c is None else c for c in x or ()], np.float64)
        scale = np.abs(v).max(initial=0)
        if not 0 < scale < np.inf:
            return None
        v = v / scale
        return (v / np.sqrt(v @ v) + 0.0).tobytes()

    def run(batches):
        for batch in batches:
            out = [None if i is None or k is None else unit(x) for i, k, x in zip(*[c.to_pylist() for c in batch.columns], strict=True)]
            group = [None if v is None else f"{len(v) // 8}/{k}" for v, k in zip(out, batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(group, pa.string()), pa.array(out, pa.binary())], ["vec_id", "group", "v"])

    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), "embedding")
    return rows.mapInArrow(run, "vec_id long, group string, v binary")


def sharded(found: DataFrame) -> DataFrame:
    """node, group, copies, v, shard, home (whether it is the node's own shard), block and blocks."""
    spark = found.sparkSession
    sizes = found.groupBy("group").agg(F.count("*").alias("n"))
    every = sizes.agg(F.sum("n")).first()[0] or 0
    share = 1 / max(SHARD, every / CENTRES)
    # About one in SHARD of each group that is larger, chosen by hash: CENTRES in all, give or take chance.
    large = sizes.where(F.col("n") > BLOCK).select("group")
    drawn = F.pmod(F.xxhash64("node", F.lit("centre")), F.lit(1 << 30)) < int(share * (1 << 30))
    rows = found.join(large, "group", "left_semi").where(drawn).select("group", "node", "v").orderBy("group", "node").limit(2 * CENTRES).collect()
    centres: dict[str, list] = {}
    for r in rows:
        centres.setdefault(r["group"], []).append(np.frombuffer(r["v"]))
    sent = spark.sparkContext.broadcast({k: np.stack(v) for k, v in centres.items()})

    def run(batches):
        for batch in batches:
            group = np.array(batch.column(0).to_pylist(), object)
            at, shard, home = [], [], []
            for g in dict.fromkeys(group):
                mine = np.flatnonzero(group == g)
                if g not in sent.value:
                    at.append(mine)
                    shard.append(np.zeros(len(mine), np.int64))
                    home.append(np.ones(len(mine), bool))
                    continue
                near = np.stack([np.frombuffer(batch.column(1)[int(i)].as_py()) for i in mine]) @ sent.value[g].T
                best = near.max(axis=1, keepdims=True)
                row, column = np.nonzero(near >= best - MARGIN)
                at.append(mine[row])
                shard.append(column)
                home.append(column == near.argmax(axis=1)[row])
            if at:
                taken = batch.take(pa.array(np.concatenate(at)))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(np.concatenate(shard)), pa.array(np.concatenate(home))], [*batch.schema.names, "shard", "home"]
                )

    rows = found.select("group", "v", "node", "copies").mapInArrow(run, "group string, v binary, node long, copies long, shard long, home boolean")
    rows = keep(rows, "ann-shards")
    n = rows.groupBy("group", "shard").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks"))
    return rows.join(n, ["group", "shard"]).withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))


def matrix(column: pa.Array) -> np.ndarray:
    return np.stack([np.frombuffer(x.as_py()) for x in column])


def pruned(x: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Adjacency of a block, -1 where a node has fewer neighbours."""
    n = len(x)
    if n < 2:
        return np.zeros((n, 0), np.int64)
    most = min(CANDIDATES, n - 1)
    out = np.full((n, DEGREE + FAR), -1)
    for begin in range(0, n, 256):
        mine = np.arange(begin, min(n, begin + 256))
        near = x[mine] @ x.T
        near[np.arange(len(mine)), mine] = -np.inf
        near_to = np.argpartition(-near, most - 1, axis=1)[:, :most]
        value = np.take_along_axis(near, near_to, axis=1)
        order = np.argsort(-value, axis=1, kind="stable")
        near_to, value = np.take_along_axis(near_to, order, axis=1), np.take_along_axis(value, order, axis=1)
        between = x[near_to] @ x[near_to].transpose(0, 2, 1)
        alive, degree = np.ones(value.shape, bool), np.zeros(len(mine), np.int64)
        for k in range(most):
            take = np.flatnonzero(alive[:, k] & (degree < DEGREE))
            out[mine[take], degree[take]] = near_to[take, k]
            degree[take] += 1
            # A neighbour chosen makes those superfluous that are much nearer to it than to the node.
            alive[take] &= ALPHA**2 * (1 - between[take, k]) > 1 - value[take]
    for j in range(FAR):
        far = mix(names.astype(np.int64).view(np.uint64) + np.uint64(j + 1)) % np.uint64(n)
        out[:, DEGREE + j] = np.where(far.astype(np.int64) == np.arange(n), -1, far.astype(np.int64))
    # Edges back, as far as there is room; those to nodes that few others know come first.
    source, target = np.nonzero(out >= 0)[0], out[out >= 0]
    known = np.bincount(target, minlength=n)
    order = np.lexsort((known[source], target))
    source, target = source[order], target[order]
    place = np.arange(len(target)) - np.searchsorted(target, target)
    room = place < MOST - DEGREE - FAR
    back = np.full((n, MOST - DEGREE - FAR), -1)
    back[target[room], place[room]] = source[room]
    return np.concatenate([out, back], axis=1)


def build(rows: DataFrame) -> DataFrame:
    """node and near: the united adjacency lists."""

    def run(table: pa.Table) -> pa.Table:
        node = table["node"].to_numpy()
        order = np.argsort(node)
        node = node[order]
        edges = pruned(matrix(table["v"].take(pa.array(order)).combine_chunks()), node)
        lists = [np.unique(node[e[e >= 0]]) for e in edges]
        return pa.table({"node": pa.array(node), "near": pa.array(lists, pa.list_(pa.int64()))})

    lists = rows.groupBy("group", "shard", "block").applyInArrow(run, "node long, near array<long>")
    return lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))


def within(x: np.ndarray, near: list[np.ndarray], entries: np.ndarray, q: np.ndarray, own: int, cosine: float) -> np.ndarray:
    """Nodes with at least that cosine: greedy beam from the entries, then expansion through the range."""
    seen = np.zeros(len(x), bool)
    beam = np.append(entries, own) if own >= 0 else entries
    seen[beam] = True
    value, done = x[beam] @ q, np.zeros(len(beam), bool)
    inside = [beam[value >= cosine - SLACK]]
    while True:
        order = np.argsort(-value, kind="stable")[:BEAM]
        beam, value, done = beam[order], value[order], done[order]
        todo = np.flatnonzero(~done)
        # Once there, the expansion below does the rest.
        if not len(todo) or value[0] >= cosine - SLACK and value[todo[0]] < cosine - SLACK or len(inside) > BEAM:
            break
        done[todo[0]] = True
        new = near[beam[todo[0]]]
        new = new[~seen[new]]
        seen[new] = True
        beam, value, done = np.append(beam, new), np.append(value, x[new] @ q), np.append(done, np.zeros(len(new), bool))
        if (value[len(value) - len(new) :] >= cosine - SLACK).any():
            inside.append(new[value[len(value) - len(new) :] >= cosine - SLACK])
    frontier = np.concatenate(inside)
    found = [frontier]
    while len(frontier):
        new = np.unique(np.concatenate([near[i] for i in frontier]))
        new = new[~seen[new]]
        seen[new] = True
        frontier = new[x[new] @ q >= cosine - SLACK]
        found.append(frontier)
    found = np.concatenate(found)
    return found[x[found] @ q >= cosine]


def search(rows: DataFrame, lists: DataFrame, cosine: float) -> DataFrame:
    """node, root (a node linked with it, or itself), links (vectors found in this block)."""

    def run(table: pa.Table) -> pa.Table:
        asks = table["asks"].to_numpy(zero_copy_only=False)
        members, queries = table.filter(pa.array(~asks)), table.filter(pa.array(asks))
        if not len(members) or not len(queries):
            return pa.table({k: pa.array([], pa.int64()) for k in ("node", "root", "links")})
        node = members["node"].to_numpy()
        order = np.argsort(node)
        node, members = node[order], members.take(pa.array(order))
        x, copies = matrix(members["v"].combine_chunks()), members["copies"].to_numpy()
        near = []
        for one in members["near"].combine_chunks():
            named = np.array(one.as_py() or [], np.int64)
            at = np.minimum(np.searchsorted(node, named), len(node) - 1)
            near.append(at[node[at] == named])
        # The member nearest to the mean of each of a few parts.
        parts = np.array_split(np.argsort(mix(node.view(np.uint64))), min(MEDOIDS, len(node)))
        entries = np.unique([p[(x[p] @ x[p].mean(axis=0)).argmax()] for p in parts])
        asked = queries["node"].to_numpy()
        names = np.unique(np.concatenate([node, asked]))
        root = np.arange(len(names))
        place, of_query = np.searchsorted(names, node), np.searchsorted(names, asked)

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = i = root[root[i]]
            return i

        links = np.zeros(len(asked), np.int64)
        for k, q in enumerate(matrix(queries["v"].combine_chunks())):
            i = np.searchsorted(node, asked[k])
            own = int(i) if i < len(node) and node[i] == asked[k] else -1
            found = within(x, near, entries, q, own, cosine)
            found = found[node[found] != asked[k]]
            links[k] = copies[found].sum()
            a = top(of_query[k])
            for j in place[found][root[place[found]] != a]:
                b = top(int(j))
                if a != b:
                    a, b = min(a, b), max(a, b)
                    root[b] = a
        joined = np.array([top(int(i)) for i in range(len(names))])
        extra = np.flatnonzero(joined != np.arange(len(names)))
        return pa.table(
            {
                "node": pa.array(np.concatenate([asked, names[extra]])),
                "root": pa.array(np.concatenate([asked, names[joined[extra]]])),
                "links": pa.array(np.concatenate([links, np.zeros(len(extra), np.int64)])),
            }
        )

    homes = rows.where("home").groupBy("group", "shard").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("chunks"))
    both = rows.join(homes, ["group", "shard"])
    key = ["group", "shard", "block", "chunk"]
    asks = both.where("home").withColumn("chunk", F.pmod(F.xxhash64("node", F.lit("chunk")), "chunks"))
    asks = asks.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    asks = asks.select(*key, "node", "copies", "v", F.lit(None).cast("array<long>").alias("near"), F.lit(True).alias("asks"))
    held = both.join(lists, "node").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    held = held.select(*key, "node", "copies", "v", "near", F.lit(False).alias("asks"))
    return held.union(asks).groupBy(*key).applyInArrow(run, "node long, root long, links long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """A row per vector: vec_id, n_links, component_id, kept.

    Only vectors with the same non-NULL label and dimension are compared. A vector that is NULL, zero or has a NULL or
    non-finite component has no link and is its own component. Rows without a vec_id link with nothing and are not kept. Equal
    rows link with each other.
    """
    given = keep(units(vectors), "ann-units")
    same = given.where("v is not null").groupBy("group", "v")
    found = keep(same.agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")), "ann-nodes")
    rows = keep(sharded(found), "ann-blocks")
    hits = keep(search(rows, keep(build(rows), "ann-graph"), cosine), "ann-hits")
    roots = components(hits.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")), "ann-links")
    links = hits.groupBy("node").agg(F.sum("links").alias("links"))
    known = found.join(links, "node", "left").join(roots, "node", "left")
    known = known.select("group", "v", "copies", "links", F.coalesce("root", "node").alias("root"))
    both = given.join(known, ["group", "v"], "left")
    root = F.coalesce("root", "vec_id")
    return both.select(
        "vec_id",
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        root.alias("component_id"),
        F.coalesce(root == F.col("vec_id"), F.lit(False)).alias("kept"),
    )


def audit(vectors: DataFrame, found: DataFrame, cosine: float = COSINE, every: int = 100) -> DataFrame:
    """Links found and there (brute force) for each vector whose id is divisible by `every`, against all rows in blocks."""
    given = keep(units(vectors).where("v is not null"), "ann-audit")
    blocks = max(1, given.count() // BLOCK)
    dealt = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    asks = given.where(F.col("vec_id") % every == 0).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(table: pa.Table) -> pa.Table:
        asked = table["asks"].to_numpy(zero_copy_only=False)
        q, m = table.filter(pa.array(asked)), table.filter(pa.array(~asked))
        n = np.zeros(len(q), np.int64)
        if len(q) and len(m):
            n = (matrix(q["v"].combine_chunks()) @ matrix(m["v"].combine_chunks()).T >= cosine).sum(axis=1)
        return pa.table({"vec_id": q["vec_id"], "n": pa.array(n)})

    columns = ("group", "block", "vec_id", "v")
    both = asks.select(*columns, F.lit(True).alias("asks")).union(
        given.withColumn("block", dealt).select(*columns, F.lit(False).alias("asks"))
    )
    there = both.groupBy("group", "block").applyInArrow(run, "vec_id long, n long").groupBy("vec_id").agg((F.sum("n") - 1).alias("there"))
    return there.join(found.select("vec_id", "n_links"), "vec_id")
