"""Exact top-k inner products by dual-tree search over cover trees.

1. Vectors become integers, floor(64 * x). A cover tree over a bounded sample gives pivots, whose number grows with the input up
   to PIVOTS; every vector goes to the nearest one. A pivot's vectors are cut into blocks of at most BLOCK rows or so (QUERIES rows
   for queries, where neighbouring pivots share a block), so a hot pivot or a vector that many rows share makes more blocks.
2. Each block becomes one row of a table, with a cover tree over its vectors that is built once.
3. Every query block meets one block of its own pivots first, which gives each query a bound from below on its k-th score.
4. Every query block descends the tree over the pivots, and passes by what cannot reach the worst of its bounds: the product of a row
   within r of a and a row within s of b is at most <a, b> + r|b| + s|a| + rs. Blocks of the pivots it comes to stand the same test.
5. For each pair of blocks that is left, a task descends both trees at once, best bound first, under the same rule with each query
   group's worst k-th score, down to leaves, whose products are computed in one go.
6. The best k over all blocks are each query's results.

What the driver holds is bounded: the sample and a row for each pivot. A set of queries that is a share of all rows makes the
work grow with the square of the input, in whole blocks, when nothing can be ruled out.

Defined results: vectors that are null or hold null, NaN, infinite or huge components (|64 x| >= 2**31) and rows without
vec_id take no part; a vector shorter than another counts as padded with zeros; a query meets all rows but its own, also those
with its vec_id or vector; equal scores go to the smaller vec_id; with fewer than k other rows all are returned; an empty table gives
an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from folioscope.llm._shared import kept, pick

K, EVERY, SCALE = 20, 20, 64
#: Rows of the sample; least and most pivots (two for each BLOCK rows between these); rows of a block and of a query block.
SAMPLE, FEW_PIVOTS, PIVOTS, BLOCK, QUERIES = 16384, 16, 4096, 8192, 1024
#: Rows of a leaf on average, and rows whose distances to all pivots are computed at once.
LEAF, SLICE = 128, 1024
_NONE = -(1 << 62)


class Node:
    """A ball of a cover tree: its point, the largest distance to a row below it (radius), its level; children, or rows of a leaf.

    A point at level l has children at level l - 1 within 2**l of it, itself among them (levels at which a point has no child but
    itself are left out). Points of a level are more than 2**level apart.
    """

    __slots__ = ("centre", "children", "level", "norm", "point", "radius", "rows")

    def __init__(self, x: np.ndarray, point: int, level: int, radius: float, rows: np.ndarray | None, children: list[Node]):
        self.centre, self.point, self.level, self.radius, self.rows, self.children = x[point], point, level, radius, rows, children
        self.norm = float(np.sqrt(self.centre @ self.centre))

    def leaves(self) -> Iterator[Node]:
        if not self.children:
            yield self
        for c in self.children:
            yield from c.leaves()


def cover_tree(x: np.ndarray, most: int) -> Node:
    """A cover tree over the rows of x with the first ``most`` points, farthest first; other rows are in the leaf of the nearest one.

    Farthest first makes the points of any level a prefix of the order: each point is as far from all before it as no later one is.
    """
    d = np.sqrt(((x - x.mean(0)) ** 2).sum(1))
    order, gaps = [int(d.argmin())], [math.inf]
    near = np.sqrt(((x - x[order[0]]) ** 2).sum(1))
    leaf = np.zeros(len(x), np.int64)
    while len(order) < most and near.max() > 0:
        order.append(int(near.argmax()))
        gaps.append(float(near.max()))
        d = np.sqrt(((x - x[order[-1]]) ** 2).sum(1))
        leaf[d < near] = len(order) - 1
        near = np.minimum(near, d)
    level = [math.ceil(math.log2(g)) - 1 for g in gaps[1:]]
    level.insert(0, level[0] + 1 if level else 0)
    by_leaf = np.split(np.argsort(leaf, kind="stable"), np.cumsum(np.bincount(leaf, minlength=len(order)))[:-1])
    low = level[-1] - (len(order) > 1)
    below = list(by_leaf)
    top = [Node(x, p, low, _radius(x, p, rows), rows, []) for p, rows in zip(order, by_leaf, strict=True)]
    points = np.array(order)
    # from the lowest level up, each point is adopted by the nearest one of the level above
    for at in sorted(set(level[1:])):
        above = [i for i in range(len(order)) if level[i] > at]
        new = [i for i in range(len(order)) if level[i] == at]
        adopted: dict[int, list[int]] = {}
        for c in new:
            by = above[int(((x[points[above]] - x[points[c]]) ** 2).sum(1).argmin())]
            adopted.setdefault(by, []).append(c)
        for by, cs in adopted.items():
            below[by] = np.concatenate([below[by], *[below[c] for c in cs]])
            top[by] = Node(x, order[by], at + 1, _radius(x, order[by], below[by]), None, [top[by], *[top[c] for c in cs]])
    return top[0]


def _radius(x: np.ndarray, point: int, rows: np.ndarray) -> float:
    return float(np.sqrt(((x[rows] - x[point]) ** 2).sum(1).max(initial=0)))


def packed(root: Node, n: int) -> dict[str, bytes]:
    """A tree over n rows as arrays: children come before parents; leaf holds the number of each row's leaf."""
    nodes: list[Node] = []
    parent: list[int] = []
    leaf = np.zeros(n, np.int32)

    def add(node: Node) -> int:
        own = [add(c) for c in node.children]
        at = len(nodes)
        nodes.append(node)
        parent.append(-1)
        for c in own:
            parent[c] = at
        if not own:
            leaf[node.rows] = at
        return at

    add(root)
    return {"point": np.array([v.point for v in nodes], "<i4").tobytes(), "level": np.array([v.level for v in nodes], "<i4").tobytes(), "radii": np.array([v.radius for v in nodes], "<f8").tobytes(), "parent": np.array(parent, "<i4").tobytes(), "leaf": leaf.astype("<i4").tobytes()}


def unpacked(x: np.ndarray, tree: dict[str, bytes]) -> Node:
    point, level, radii, parent, leaf = (np.frombuffer(tree[c], t) for c, t in (("point", "<i4"), ("level", "<i4"), ("radii", "<f8"), ("parent", "<i4"), ("leaf", "<i4")))
    children: list[list[Node]] = [[] for _ in point]
    rows = np.split(np.argsort(leaf, kind="stable"), np.cumsum(np.bincount(leaf, minlength=len(point)))[:-1])
    node = None
    for i in range(len(point)):
        node = Node(x, int(point[i]), int(level[i]), float(radii[i]), None if children[i] else rows[i], children[i])
        if parent[i] >= 0:
            children[parent[i]].append(node)
    return node


def reach(a: Node, b: Node) -> float:
    """No inner product of a row of a and a row of b is larger (but for rounding, which is allowed for)."""
    v = float(a.centre @ b.centre) + a.radius * b.norm + b.radius * a.norm + a.radius * b.radius
    return v + 1e-6 + 1e-9 * abs(v)


def search(q: np.ndarray, q_row: np.ndarray, q_tree: Node, x: np.ndarray, x_row: np.ndarray, x_tree: Node, k: int, floor: np.ndarray, met: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of query, index of row and score of each query's k best rows among x, whose rows are in order of vec_id.

    floor: scores below a query's are of no use to it. met: takes the number of products of each pair of leaves.
    """
    n, bits = len(x), max(1, int(len(x)).bit_length())
    big = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if big >= 2 ** min(53, 62 - bits):
        return _plain(q, q_row, x, x_row, k)
    best = np.full((len(q), k), _NONE, np.int64)  # score * 2**bits + (n - place): larger is better
    worst = np.array(floor, np.float64)
    back = np.arange(n, 0, -1, dtype=np.int64)
    by_row = {int(r): i for i, r in enumerate(x_row)}
    own = np.array([by_row.get(int(r), -1) for r in q_row])

    def leaf(qs: np.ndarray, rows: np.ndarray) -> None:
        if met is not None:
            met.append(len(qs) * len(rows))
        s = np.rint(q[qs] @ x[rows].T).astype(np.int64)
        key = (s << bits) + back[rows]
        key[own[qs][:, None] == rows[None, :]] = _NONE
        all_ = np.concatenate([best[qs], key], 1)
        best[qs] = np.partition(all_, all_.shape[1] - k, 1)[:, -k:]
        kth = best[qs].min(1)
        worst[qs] = np.maximum(worst[qs], np.where(kth == _NONE, -np.inf, kth >> bits))

    def descend(b: Node, nodes: list[tuple[float, Node]]) -> None:
        """nodes: those that b may still have to meet, with their reach from a ball around b."""
        if b.children:
            for c in b.children:
                descend(c, [(reach(c, d), d) for _, d in nodes])
            return
        low = worst[b.rows].min()
        todo = [(-bound, i, d) for i, (bound, d) in enumerate(nodes)]
        heapq.heapify(todo)
        made = len(todo)
        while todo and -todo[0][0] >= low:
            _, _, d = heapq.heappop(todo)
            for c in d.children:
                made += 1
                if (bound := reach(b, c)) >= low:
                    heapq.heappush(todo, (-bound, made, c))
            if not d.children:
                leaf(b.rows, d.rows)
                low = worst[b.rows].min()

    descend(q_tree, [(reach(q_tree, x_tree), x_tree)])
    i, j = np.nonzero(best != _NONE)
    key = best[i, j]
    return i, n - (key & ((1 << bits) - 1)), key >> bits


def _plain(q, q_row, x, x_row, k):
    """Like search, with Python's integers, for components too large for exact floating-point products."""
    out = []
    xi = [[int(c) for c in r] for r in x]
    for i, r in enumerate(q):
        own = [int(c) for c in r]
        s = sorted((-sum(a * b for a, b in zip(own, c, strict=True)), j) for j, c in enumerate(xi) if x_row[j] != q_row[i])[:k]
        out += [(i, j, -v) for v, j in s]
    cols = list(zip(*out, strict=True)) or [[], [], []]
    return np.array(cols[0], np.int64), np.array(cols[1], np.int64), np.array(cols[2], np.int64)


def _matrix(raw: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(raw, "<i4").reshape(-1, dim).astype(np.float64)


_BASE = "row long, vec_id long, is_query boolean, cell int, away double, v binary"


def _assign(pivots: np.ndarray, every: int):
    dim = pivots.shape[1]

    def run(batches):
        for whole in batches:
            for at in range(0, len(whole), SLICE):
                batch = whole.slice(at, SLICE)
                x = np.zeros((len(batch), dim))
                lists = batch.column(2)
                lens = np.diff(lists.offsets.to_numpy())
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                place = np.repeat(np.arange(len(batch)), lens)
                x[place, np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)] = flat
                d = (x**2).sum(1)[:, None] - 2 * x @ pivots.T + (pivots**2).sum(1)
                cell = d.argmin(1)
                away = np.sqrt(((x - pivots[cell]) ** 2).sum(1))
                ids = batch.column(1).to_numpy()
                raw = x.astype("<i4")
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids % every == 0), pa.array(cell.astype(np.int32)), pa.array(away), pa.array([r.tobytes() for r in raw], pa.binary())], ["row", "vec_id", "is_query", "cell", "away", "v"])

    return run


_TREE = ["point", "level", "radii", "parent", "leaf"]
_BLOCK = "cell int, part int, n long, centre array<double>, norm double, radius double, rows binary, ids binary, v binary, " + ", ".join(f"{c} binary" for c in _TREE)


def _block(dim: int, leaf: int):
    """The rows of a block, in order of vec_id, with their tree, as one row."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["vec_id", "row"])
        raw = b"".join(rows["v"])
        x = _matrix(raw, dim)
        root = cover_tree(x, max(1, len(x) // leaf))
        out = {"cell": rows["cell"].iloc[0], "part": rows["part"].iloc[0], "n": len(x), "centre": root.centre.tolist(), "norm": root.norm, "radius": root.radius}
        out |= {"rows": rows["row"].to_numpy("<i8").tobytes(), "ids": rows["vec_id"].to_numpy("<i8").tobytes(), "v": raw} | packed(root, len(x))
        return pd.DataFrame([out])

    return run


_FOUND = "q_cell int, q_part int, q_row long, query_id long, vec_id long, score long"


def _pairs(dim: int, k: int):
    """Rows of a query block, a block and bounds (floor_row, floor) of its queries -> the best k of each query."""

    def side(row: dict, of: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, Node]:
        x = _matrix(row[f"{of}v"], dim)
        return x, np.frombuffer(row[f"{of}rows"], "<i8"), np.frombuffer(row[f"{of}ids"], "<i8"), unpacked(x, {c: row[f"{of}{c}"] for c in _TREE})

    def run(batches):
        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1).to_pylist()[0]
                q, q_row, q_id, q_tree = side(row, "q_")
                x, x_row, x_id, x_tree = side(row, "x_")
                low = {f["row"]: f["floor"] for f in row["floors"] or []}
                i, j, s = search(q, q_row, q_tree, x, x_row, x_tree, k, np.array([low.get(int(r), -math.inf) for r in q_row]))
                cell = [np.full(len(i), row[c], np.int32) for c in ("q_cell", "q_part")]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*cell, q_row[i], q_id[i], x_id[j], s.astype(np.int64))], ["q_cell", "q_part", "q_row", "query_id", "vec_id", "score"])

    return run


class _Ball:
    """A query block as one ball."""

    def __init__(self, centre: np.ndarray, radius: float):
        self.centre, self.radius, self.norm = centre, radius, float(np.sqrt(centre @ centre))


def _reached(centres: np.ndarray, tree: dict[str, bytes], cells: dict[int, float]):
    """Query blocks (q_cell, q_part, centre, radius, low) -> the cells that may hold rows for them. cells: largest distance by cell."""

    def run(batches):
        top = unpacked(centres, tree)

        def widened(node: Node) -> float:  # the radius over the rows of all cells below, not over the pivots alone
            own = [widened(c) for c in node.children]
            below = [p for leaf in node.leaves() for p in leaf.rows]
            node.radius = max((float(np.sqrt(((centres[p] - node.centre) ** 2).sum())) + cells[p] for p in below if p in cells), default=-1.0)
            return max([node.radius, *own])

        widened(top)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                ball, todo = _Ball(np.array(r["centre"]), r["radius"]), [top]
                while todo:
                    node = todo.pop()
                    if node.radius < 0 or reach(ball, node) < r["low"]:
                        continue
                    todo += node.children
                    if not node.children:
                        out += [(r["q_cell"], r["q_part"], int(p)) for p in node.rows if p in cells]
            cols = list(zip(*out, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()) for c in cols], ["q_cell", "q_part", "cell"])

    return run


def top_k(vectors: DataFrame, spark: SparkSession | None = None, k: int = K, every: int = EVERY, scale: int = SCALE, pivots: int | None = None, block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: queries are the rows whose vec_id is divisible by ``every``."""
    spark = spark or vectors.sparkSession
    v = F.transform("embedding", lambda c: F.floor(c.cast("double") * scale))
    fits = F.forall("embedding", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double") * scale) < 2.0**31), F.lit(False)))
    rows = pick(vectors, "vec_id", "embedding").where(F.col("vec_id").isNotNull() & F.coalesce(fits, F.lit(False)))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<long>").alias("v"))
    dim, n = rows.agg(F.max(F.size("v")), F.count(F.lit(1))).first()
    if dim is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dim = max(1, dim)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "row").limit(SAMPLE).select("v").collect()
    s = np.zeros((len(sample), dim))
    for i, r in enumerate(sample):
        s[i, : len(r[0])] = r[0]
    # the points of the sample's tree are the pivots, numbered so that neighbours in the tree are neighbours
    top = cover_tree(s, pivots or min(PIVOTS, max(FEW_PIVOTS, 2 * -(-n // block))))
    centres = s[[leaf.point for leaf in top.leaves()]]
    tree = packed(cover_tree(centres, len(centres)), len(centres))
    base = kept(rows.mapInArrow(_assign(centres, every), _BASE), spark, "topk-rows")

    counts = base.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_query").cast("int")).alias("m"), F.max("away").alias("away")).orderBy("cell").collect()  # a row for each pivot
    # neighbouring cells with few queries share a query block, which first meets the largest of them
    groups: list[list] = []
    for r in counts:
        if not groups or sum(g["m"] for g in groups[-1]) + r["m"] > queries:
            groups.append([])
        groups[-1].append(r)
    cells = []
    for g in groups:
        home, asked = max(g, key=lambda r: r["n"])["cell"], sum(r["m"] for r in g)
        cells += [(r["cell"], max(1, -(-r["n"] // block)), home, max(1, -(-asked // queries))) for r in g]
    cells = F.broadcast(spark.createDataFrame(cells, "c int, parts int, home int, q_parts int"))
    part = lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("int").alias("part")
    base = base.join(cells, F.col("cell") == F.col("c"))
    blocks = lambda df, leaf: df.groupBy("cell", "part").applyInPandas(_block(dim, leaf), _BLOCK)
    named = lambda df, of: df.select(*[F.col(c).alias(of + c) for c in df.columns])  # noqa: E731  the sides of a pair have the same columns
    x = named(kept(blocks(base.select("cell", part("parts"), "row", "vec_id", "v"), LEAF), spark, "topk-blocks"), "x_")
    q = named(kept(blocks(base.where("is_query").select(F.col("home").alias("cell"), part("q_parts"), "row", "vec_id", "v"), LEAF), spark, "topk-queries"), "q_")

    no_floors = F.lit(None).cast("array<struct<row:long,floor:double>>").alias("floors")
    first = kept(q.join(x.where("x_part = 0"), F.col("q_cell") == F.col("x_cell")).select("*", no_floors).mapInArrow(_pairs(dim, k), _FOUND), spark, "topk-first")
    by_query = first.groupBy("q_cell", "q_part", "q_row").agg(F.when(F.count(F.lit(1)) >= k, F.min("score").cast("double")).otherwise(F.lit(-math.inf)).alias("floor"))
    floors = by_query.groupBy("q_cell", "q_part").agg(F.collect_list(F.struct(F.col("q_row").alias("row"), "floor")).alias("floors"), F.min("floor").alias("low"))  # a block's queries
    asks = kept(q.join(floors, ["q_cell", "q_part"], "left").withColumn("low", F.when(F.size("floors") == F.col("q_n"), F.col("low")).otherwise(F.lit(-math.inf))), spark, "topk-asks")

    balls = asks.select("q_cell", "q_part", F.col("q_centre").alias("centre"), F.col("q_radius").alias("radius"), "low")
    cells_met = balls.mapInArrow(_reached(centres, tree, {r["cell"]: r["away"] for r in counts}), "q_cell int, q_part int, cell int")
    met = cells_met.join(x.select("x_cell", "x_part", "x_centre", "x_norm", "x_radius"), F.col("cell") == F.col("x_cell"))
    met = met.join(asks.select("q_cell", "q_part", "q_centre", "q_norm", "q_radius", "low"), ["q_cell", "q_part"])
    product = F.aggregate(F.zip_with("q_centre", "x_centre", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    most = product + F.col("q_radius") * F.col("x_norm") + F.col("x_radius") * F.col("q_norm") + F.col("q_radius") * F.col("x_radius")
    done = (F.col("q_cell") == F.col("x_cell")) & (F.col("x_part") == 0)
    todo = kept(met.where(~done & (most + 1e-6 + F.abs(most) * 1e-9 >= F.col("low"))).select("q_cell", "q_part", "x_cell", "x_part"), spark, "topk-pairs")
    pair = ["q_cell", "q_part", "x_cell", "x_part"]
    both = asks.join(todo, ["q_cell", "q_part"]).join(x.join(todo, ["x_cell", "x_part"]), pair)
    rest = both.mapInArrow(_pairs(dim, k), _FOUND)
    rank = F.row_number().over(W.partitionBy("q_row").orderBy(F.desc("score"), "vec_id"))
    return first.union(rest).withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = f"""
WITH v AS (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.row AS q_row, q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % {EVERY} = 0 AND q.row <> c.row),
r AS (SELECT *, row_number() OVER (PARTITION BY q_row ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= {K}"""
