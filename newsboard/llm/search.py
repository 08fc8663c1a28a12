"""Exact top-k inner products with a KD-tree per shard."""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from newsboard.llm.common import landed

K = 10
LEAF = 64
SHARD_ROWS = 4096
SHARDS_AT_ONCE = 4
QUERIES_AT_ONCE = 512
#: Cells that the first median splits make at most, so that their boxes can be
#: sent to all tasks, and sampled rows that a cell's split is fitted on.
MOST_CELLS = 4096
SAMPLED_PER_CELL = 16
#: A gap of this share of the spread, near the median, is cut in its place.
WIDE_GAP = 0.1
_FOUND = ["query_row", "query_id", "vec_id", "score", "row"]
_LARGE = 2**62


def quantised(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of every component, x as double; NULL for a vector that
    is NULL or holds a component that is NULL or not finite."""
    x = F.transform(vector, lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.when(F.coalesce(finite, F.lit(False)), F.transform(x, lambda v: F.floor(v * scale).cast("bigint")))


def _saturated(score: int) -> int:
    return max(-(2**63), min(2**63 - 1, int(score)))


def bounds(query: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, the highest score with it that each box can hold); in Python's
    integers where 64 bits could overflow."""
    big = int(np.abs(query.astype(object)).max(initial=0)) * max(
        abs(int(lo.min(initial=0))), abs(int(hi.max(initial=0)))
    ) * len(query) >= _LARGE
    q = query.astype(object) if big else query
    return q, np.maximum(q * lo, q * hi).sum(axis=1)


class Cuts:
    """The first median splits: from a sample to about ``cells`` cells,
    numbered so that near numbers are near in space."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.axis, self.at, self.sides, self.cells = [], [], [], 0
        self._grow(sample, cells)

    def _grow(self, points: np.ndarray, cells: int) -> int:
        """The number of a new node, or -1 - the number of a new cell."""
        spread = points.max(axis=0).astype(float) - points.min(axis=0) if len(points) else np.zeros(1)
        axis = int(np.argmax(spread))
        if cells < 2 or not spread[axis]:
            self.cells += 1
            return -self.cells
        values = np.sort(points[:, axis])
        middle = len(values) * (cells // 2) // cells
        near = slice(max(1, middle - len(values) // 8), middle + len(values) // 8 + 1)
        gaps = np.diff(values, prepend=values[0])[near].astype(float)
        if gaps.max(initial=0) > spread[axis] * WIDE_GAP:  # clusters end here
            middle = near.start + int(np.argmax(gaps))
        at = max(values[middle], values[values > values[0]][0])
        node = len(self.axis)
        self.axis.append(axis)
        self.at.append(int(at))
        self.sides.append([0, 0])
        below = points[:, axis] < at
        self.sides[node][0] = self._grow(points[below], cells // 2)
        self.sides[node][1] = self._grow(points[~below], cells - cells // 2)
        return node

    def cell(self, points: np.ndarray) -> np.ndarray:
        if not self.axis:
            return np.zeros(len(points), np.int32)
        axis, at, sides = np.array(self.axis), np.array(self.at), np.array(self.sides)
        node = np.zeros(len(points), np.int64)
        while len(open_ := np.flatnonzero(node >= 0)):
            n = node[open_]
            node[open_] = sides[n, (points[open_, axis[n]] >= at[n]).astype(int)]
        return (-1 - node).astype(np.int32)


class Tree:
    """KD-tree of integer points with tight boxes; node 0 is the root."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, points: np.ndarray, leaf: int = LEAF):
        order, self.spans, self.children, lo, hi = np.arange(len(points)), [], [], [], []
        todo = [(0, len(points), None)]
        while todo:
            a, b, parent = todo.pop()
            node = len(self.spans)
            if parent is not None:
                self.children[parent].append(node)
            inside = points[order[a:b]]
            low, high = inside.min(axis=0), inside.max(axis=0)  # of the points, not of the cut
            self.spans.append((a, b))
            self.children.append([])
            lo.append(low)
            hi.append(high)
            axis = int(np.argmax(high.astype(float) - low.astype(float)))
            if b - a > leaf and high[axis] > low[axis]:
                middle = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(inside[:, axis], middle)]
                todo += [(a, a + middle, node), (a + middle, b, node)]
        self.lo, self.hi = np.array(lo), np.array(hi)
        self.ids, self.rows, self.points = ids[order], rows[order], points[order]

    def search(self, query: np.ndarray, own: int, best: list[tuple[int, int, int]], k: int) -> None:
        """Merge the best points for ``query`` into ``best``, a heap of at most
        k (score, -id, row); its least score, from this and earlier trees,
        bounds the traversal.  ``own`` is the query's row, left out."""
        q, bound = bounds(query, self.lo, self.hi)
        heap = [(-bound[0], 0)]
        while heap:
            most, node = heapq.heappop(heap)
            if len(best) == k and -most < best[0][0]:
                return  # no open box can hold a better point
            if self.children[node]:
                for child in self.children[node]:
                    if len(best) < k or bound[child] >= best[0][0]:
                        heapq.heappush(heap, (-bound[child], child))
                continue
            a, b = self.spans[node]
            scores = self.points[a:b].astype(q.dtype) @ q
            if len(best) == k:
                near = np.flatnonzero(scores >= best[0][0])
            else:
                near = np.arange(b - a)
            for i in near.tolist():
                entry = (_saturated(scores[i]), -int(self.ids[a + i]), int(self.rows[a + i]))
                if entry[2] == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Vectors as rows of ``width``; shorter ones are padded with zeros."""
    out = np.zeros((len(vectors), width), np.int64)
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return out


def top_k(
    vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector: str = "embedding", k: int = K,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` candidates with the highest
    integer inner products, for the rows of ``vectors`` where ``queries`` holds.

    Every row but the query's own is a candidate.  Ties go to the smaller id;
    a query with fewer candidates gets all of them.  Rows that repeat an id are
    rows of their own.  Rows with a NULL id, or a vector that is NULL or holds
    a NULL or non-finite component, take no part; a shorter vector counts as
    padded with zeros; scores past 64 bits saturate and tie there.  No rows give no rows.

    The first median splits are fitted on a sample of at most
    ``SAMPLED_PER_CELL * MOST_CELLS`` rows and deal every row to a cell; a cell
    is dealt by hash to shards of about ``shard_rows``, each with its tree, so
    copies of one vector fill many shards.  A query first searches its own
    shard.  Its k-th score there decides which cells it has to meet: those
    whose tight box can hold such a score.  Only pairs of a block of queries
    and a group of shards that some query has to meet are shuffled; the group's
    trees are searched one after the other, each handing its k-th score on.
    The best of all groups are merged by a ranking that keeps k rows per task.
    Memory is a block of queries, a group of trees and the boxes of the cells,
    whatever the size of the table; the work is queries times rows, less what
    the boxes prune.
    """
    given = vectors.select(
        F.col(id_col).cast("bigint").alias("id"), quantised(F.col(vector)).alias("v"), queries.alias("asks")
    ).filter(F.col("id").isNotNull() & F.col("v").isNotNull())
    rows = landed(given.withColumn("row", F.monotonically_increasing_id()), "vectors")
    n, width = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    width, spark = max(width or 0, 1), vectors.sparkSession
    cells = max(1, min(MOST_CELLS, -(-n // shard_rows)))
    most = cells * SAMPLED_PER_CELL
    sample = rows.filter(F.pmod(F.xxhash64("row"), F.lit(max(1, n))) < most).select("v").limit(2 * most)
    cuts = Cuts(_matrix(pd.Series([r["v"] for r in sample.collect()], dtype=object), width), cells)

    @F.pandas_udf("int")
    def cell_of(v: pd.Series) -> pd.Series:
        return pd.Series(cuts.cell(_matrix(v, width)), dtype="int32")

    located = landed(rows.withColumn("cell", cell_of("v")), "located")
    sizes = {r[0]: r[1:] for r in located.groupBy("cell").agg(F.count("*"), F.count_if("asks")).collect()}
    plan, shards, blocks, room = [], 0, 0, 0
    for cell, (members, asking) in sorted(sizes.items()):
        own = -(-members // shard_rows)
        wanted = max(1, -(-asking // QUERIES_AT_ONCE))
        if asking > room or wanted > 1:  # cells share a block while it has room
            blocks, room = blocks + wanted, max(0, wanted * QUERIES_AT_ONCE - asking) if wanted == 1 else 0
        else:
            room -= asking
        plan.append((cell, shards, own, blocks - wanted if blocks else 0, wanted))
        shards += own
    dealt = lambda to, seed: F.pmod(F.xxhash64(F.lit(seed), "row"), F.col(to)).cast("int")
    deals = spark.createDataFrame(plan, "cell int, shard0 int, shards int, block0 int, blocks int")  # a row per cell
    placed = located.join(F.broadcast(deals), "cell").select(
        "id", "v", "asks", "row", "cell", (F.col("shard0") + dealt("shards", 1)).alias("shard"),
        (F.col("block0") + dealt("blocks", 2)).alias("block"),
    )

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree, first = Tree(pdf["id"].to_numpy(), pdf["row"].to_numpy(), _matrix(pdf["v"], width)), pdf.iloc[0]
        return pd.DataFrame({
            "cell": [first["cell"]], "shard": [first["shard"]], "part": [first["shard"] // SHARDS_AT_ONCE],
            "lo": [tree.lo[0]], "hi": [tree.hi[0]], "tree": [pickle.dumps(tree)],
        })

    trees = landed(
        placed.groupBy("shard").applyInPandas(
            build, "cell int, shard int, part int, lo array<bigint>, hi array<bigint>, tree binary"
        ),
        "trees",
    )
    tight = (
        trees.select("cell", F.posexplode(F.arrays_zip("lo", "hi")))
        .groupBy("cell", "pos").agg(F.min("col.lo").alias("lo"), F.max("col.hi").alias("hi"))
        .groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("pos", "lo", "hi"))).alias("sides"))
    )
    boxes = {r["cell"]: ([x["lo"] for x in r["sides"]], [x["hi"] for x in r["sides"]]) for r in tight.collect()}
    sent = spark.sparkContext.broadcast((
        np.array([boxes[p[0]][0] for p in plan], np.int64).reshape(-1, width),
        np.array([boxes[p[0]][1] for p in plan], np.int64).reshape(-1, width),
        [range(p[1] // SHARDS_AT_ONCE, (p[1] + p[2] - 1) // SHARDS_AT_ONCE + 1) for p in plan],
    ))

    def begin(trees: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked):
            tree, matrix = pickle.loads(trees["tree"].iloc[0]), _matrix(asked["v"], width)
            for q, (block, shard, query, row) in enumerate(asked[["block", "shard", "id", "row"]].itertuples(index=False)):
                best: list = []
                tree.search(matrix[q], row, best, k)
                out.append((block, pickle.dumps((row, query, shard, matrix[q], best))))
        return pd.DataFrame(out, columns=["block", "query"])

    def reach(block: pd.DataFrame) -> pd.DataFrame:
        lo, hi, parts = sent.value
        met: dict[int, list] = {}
        for data in block["query"]:
            query = pickle.loads(data)
            best = query[4]
            near = range(len(lo))
            if len(best) == k:
                near = [c for c, most in enumerate(bounds(query[3], lo, hi)[1]) if _saturated(most) >= best[0][0]]
            for part in {p for c in near for p in parts[c]}:
                met.setdefault(part, []).append(query)
        out = [(block["block"].iloc[0], part, len(held), pickle.dumps(held)) for part, held in met.items()]
        return pd.DataFrame(out, columns=["block", "part", "n", "queries"])

    def search(trees: pd.DataFrame, met: pd.DataFrame) -> pd.DataFrame:
        out = []
        loaded = [(shard, pickle.loads(data)) for shard, data in trees.sort_values("shard")[["shard", "tree"]].itertuples(index=False)]
        for row, query, own, vector_, best in pickle.loads(met["queries"].iloc[0]) if len(met) else ():
            known = {r for _, _, r in best}
            for shard, tree in loaded:
                if shard != own:
                    tree.search(vector_, row, best, k)
            out += [(row, query, -i, s, r) for s, i, r in best if r not in known]
        return pd.DataFrame(out, columns=_FOUND).astype("int64")

    def own_hits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            began = map(pickle.loads, pdf["query"])
            out = [(row, query, -i, s, r) for row, query, _, _, best in began for s, i, r in best]
            yield pd.DataFrame(out, columns=_FOUND).astype("int64")

    shape = ", ".join(f"{c} long" for c in _FOUND)
    begun = landed(
        trees.select("shard", "tree").groupBy("shard").cogroup(placed.filter("asks").groupBy("shard"))
        .applyInPandas(begin, "block int, query binary"),
        "begun",
    )
    reached = landed(begun.groupBy("block").applyInPandas(reach, "block int, part int, n int, queries binary"), "reached")
    found = (
        trees.select("part", "shard", "tree").join(reached.select("part", F.col("block").alias("to")), "part")
        .groupBy("to", "part")
        .cogroup(reached.groupBy("block", "part"))
        .applyInPandas(search, shape)
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return (
        begun.mapInPandas(own_hits, shape).unionByName(found)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
