"""Exact top-k inner products by best-first search of M-trees.

Inner products become a metric by one more component: with M the greatest length of a vector, x
turns into (x, sqrt(M^2 - |x|^2)) and a query q into (q, 0), and then |q' - x'|^2 = |q|^2 + M^2 - 2 q.x,
so nearest in distance is highest in product. Vectors go to the nearest of a bounded number of
pivots; each pivot's vectors form blocks, each an M-tree of pages: an inner page has routing vectors,
covering radii and distances to its parent's routing vector, a leaf page vectors and their distances to
it. A search takes pages in order of their least possible distance. Entries whose stored parent
distance already puts them beyond the k-th best, by the triangle inequality, are passed over
without computing a distance.

Every query is first searched in its own block; its k-th best there bounds all other searches. It
then visits only the blocks whose pivot and radius allow a better or equal product. Bounds are
widened by a small relative slack, and the products themselves are whole numbers.

Defined cases: vectors that are null or hold a null or non-finite component, and rows without id,
take no part; shorter vectors count as padded with zeros; equal products go by smaller id; repeated
ids are rows of their own; fewer rows than k give fewer results; an empty table gives none.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelane.llm.common import pieces, written

SCALE = 64
MOST_PIVOTS = 256
BLOCK_ROWS = 4096
LEAF_ROWS = 512
FANOUT = 16
QUERIES_PER_CHUNK = 4096
EXACT = 2.0**53


def quantised(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """id and whole-numbered vector of the rows that take part."""
    bad = F.exists(
        column,
        lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")),
    )
    return vectors.where(F.col(key).isNotNull() & F.col(column).isNotNull() & ~bad).select(
        F.col(key).cast("long").alias("id"),
        F.transform(column, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"),
    )


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    rows = column.to_pylist()
    out = np.zeros((len(rows), width), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _raised(v: np.ndarray, most: float) -> np.ndarray:
    """The vectors with the component that makes their lengths equal."""
    x = v.astype(np.float64)
    return np.hstack([x, np.sqrt(np.maximum(0.0, most * most - (x * x).sum(1)))[:, None]])


def _distances(centre: np.ndarray, points: np.ndarray) -> np.ndarray:
    d = points - centre
    return np.sqrt(np.einsum("ij,ij->i", d, d))


class Tree:
    """An M-tree over whole-numbered vectors, built from the top by nearest routing vectors."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, most: float):
        order = np.argsort(ids, kind="stable")
        self.ids, self.v, self.most = ids[order], v[order], most
        self.points = _raised(self.v, most)
        self.largest = float(np.abs(self.v).max(initial=0)) * max(1, v.shape[1])
        self.pages: list[dict] = []
        self.computed = 0
        centre = self.points.mean(0)
        self.root = self._build(np.arange(len(ids)), centre)
        self.centre = centre

    def _build(self, rows: np.ndarray, centre: np.ndarray) -> int:
        away = _distances(centre, self.points[rows])
        if len(rows) > LEAF_ROWS:
            # routing vectors: far from those taken before, the first at random
            picks, near = [int(rows[len(rows) // 2])], np.full(len(rows), np.inf)
            while len(picks) < FANOUT:
                near = np.minimum(near, _distances(self.points[picks[-1]], self.points[rows]))
                if near.max() == 0:
                    break
                picks.append(int(rows[int(near.argmax())]))
            if len(picks) > 1:
                gaps = np.stack([_distances(self.points[p], self.points[rows]) for p in picks])
                nearest, gap = gaps.argmin(0), gaps.min(0)
                children, centres, radii = [], [], []
                for k, p in enumerate(picks):
                    mine = nearest == k
                    children.append(self._build(rows[mine], self.points[p]))
                    centres.append(self.points[p])
                    radii.append(float(gap[mine].max()))
                centres = np.array(centres)
                self.pages.append(
                    {"leaf": False, "children": children, "centres": centres, "radii": np.array(radii), "parent": _distances(centre, centres)}
                )
                return len(self.pages) - 1
        # equal vectors may overfill a page
        self.pages.append({"leaf": True, "ids": self.ids[rows], "v": self.v[rows], "exact": self.points[rows, :-1], "parent": away})
        return len(self.pages) - 1

    def search(self, q: np.ndarray, k: int, skip: int | None, floor: int | None) -> list[tuple[int, int]]:
        """The k best (product, id), without ``skip``; products below ``floor`` are of no use."""
        point = np.append(q.astype(np.float64), 0.0)
        base = float(point @ point) + self.most * self.most
        slack = 1e-9 * base + 1e-6
        # floating-point products only where they are exact
        exact = self.largest * float(np.abs(q).max(initial=0)) < EXACT
        best: list[tuple[int, int]] = []  # a heap of (product, -id)

        def reach() -> float:
            """Distance beyond which nothing is of use."""
            least = best[0][0] if len(best) == k else floor
            if floor is not None and least is not None:
                least = max(least, floor)
            return math.inf if least is None else math.sqrt(max(0.0, base - 2.0 * least + slack))

        queue = [(0.0, self.root, float(np.sqrt(((point - self.centre) ** 2).sum())))]
        while queue:
            nearest, page, away = heapq.heappop(queue)
            limit = reach()
            if nearest > limit:
                break
            page = self.pages[page]
            if page["leaf"]:
                names, v = page["ids"], page["exact"] if exact else page["v"]
                if limit < math.inf:
                    near = np.abs(page["parent"] - away) <= limit + 1e-6
                    if not near.all():
                        names, v = names[near], v[near]
                self.computed += len(names)
                products = v @ (point[:-1] if exact else q)
                if exact:
                    products = products.astype(np.int64)
                least = best[0][0] if len(best) == k else floor
                if least is not None:
                    enough = products >= least
                    products, names = products[enough], names[enough]
                if skip is not None and len(names):
                    other = names != skip
                    products, names = products[other], names[other]
                if len(products) > k:
                    order = np.lexsort((names, -products))[:k]
                    products, names = products[order], names[order]
                for entry in zip(products.tolist(), (-names).tolist(), strict=True):
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
            else:
                use = np.abs(page["parent"] - away) - page["radii"] <= limit + 1e-6
                picked = np.flatnonzero(use)
                self.computed += len(picked)
                gaps = _distances(point, page["centres"][picked])
                for i, gap in zip(picked.tolist(), gaps.tolist(), strict=True):
                    low = max(0.0, gap - page["radii"][i] - 1e-6)
                    if low <= limit:
                        heapq.heappush(queue, (low, page["children"][i], gap))
        return sorted(((s, -n) for s, n in best), key=lambda x: (-x[0], x[1]))


FOUND = "query_id long, vec_id long, score long"


def _found(rows: list[tuple[int, int, int]]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [(), (), ()]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns, strict=True)})


def top_k(vectors: DataFrame, is_query: F.Column, k: int = 20) -> DataFrame:
    """The k highest products of each query row with all other rows: query_id, rank, vec_id, score.

    ``vectors`` has id and v (array of long); ``is_query`` is a condition on id.
    """
    spark = vectors.sparkSession
    vectors = written(vectors.select("id", "v", is_query.alias("is_query")), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    total, queries, width, longest = vectors.agg(
        F.count("*"), F.sum(F.col("is_query").cast("long")), F.max(F.size("v")), F.max(square)
    ).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not total or not queries:
        return empty
    width, most = max(1, width), math.sqrt(longest)
    wanted = min(MOST_PIVOTS, pieces(total, BLOCK_ROWS))
    sample = vectors.select("v").orderBy(F.xxhash64("id"), "id").limit(wanted).collect()
    start = np.zeros((len(sample), width), np.int64)
    for i, row in enumerate(sample):
        start[i, : len(row["v"])] = row["v"]
    pivots = _raised(np.unique(start, axis=0), most)

    def nearest(batches):
        for batch in batches:
            points = _raised(_matrix(batch.column("v"), width), most)
            gaps = np.stack([_distances(p, points) for p in pivots]) if len(points) else np.empty((len(pivots), 0))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(gaps.argmin(0).astype(np.int32)),
                    pa.array(gaps.min(0)),
                ],
                names=["id", "v", "is_query", "pivot", "gap"],
            )

    placed = written(
        vectors.mapInArrow(nearest, "id long, v array<bigint>, is_query boolean, pivot int, gap double"), "placed"
    )
    sizes = placed.groupBy("pivot").agg(F.count("*").alias("n"), F.max("gap").alias("radius")).collect()  # MOST_PIVOTS rows
    blocks = {r["pivot"]: pieces(r["n"], BLOCK_ROWS) for r in sizes}
    radii = {r["pivot"]: r["radius"] for r in sizes}
    number = F.create_map(*[F.lit(x) for p, n in blocks.items() for x in (p, n)])
    block = F.struct("pivot", F.pmod(F.xxhash64("id"), number[F.col("pivot")]).cast("int").alias("part"))
    tasks = sum(blocks.values())
    placed = placed.withColumn("block", block).select(
        F.col("block.pivot").alias("pivot"), F.col("block.part").alias("part"), "id", "v", "is_query"
    )

    def at_home(table: pa.Table) -> pa.Table:
        ids, v = table.column("id").to_numpy(), _matrix(table.column("v"), width)
        tree, rows = Tree(ids, v, most), []
        for i in np.flatnonzero(table.column("is_query").to_numpy(zero_copy_only=False)):
            rows += [(int(ids[i]), name, score) for score, name in tree.search(v[i], k, int(ids[i]), None)]
        return _found(rows)

    local = written(placed.repartition(tasks, "pivot", "part").groupBy("pivot", "part").applyInArrow(at_home, FOUND), "home")
    bound = local.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    asked = placed.where("is_query").join(bound, placed["id"] == bound["query_id"], "left").select(
        "pivot", "part", "id", "v", F.when(F.col("n") >= k, F.col("least")).alias("least")
    )

    def routes(batches):
        names = sorted(blocks)
        centres = pivots[names]
        reach = np.array([radii[p] for p in names])
        for batch in batches:
            rows = []
            q = _matrix(batch.column("v"), width)
            points = np.hstack([q.astype(np.float64), np.zeros((len(q), 1))])
            for i, (home, part, name, least) in enumerate(
                zip(*(batch.column(c).to_pylist() for c in ("pivot", "part", "id", "least")), strict=True)
            ):
                base = float(points[i] @ points[i]) + most * most
                gap = np.maximum(0.0, _distances(points[i], centres) - reach - 1e-6)
                able = base - gap * gap + 1e-9 * base + 1e-6
                for j in np.flatnonzero(able >= 2.0 * least if least is not None else np.full(len(names), True)):
                    p = names[j]
                    rows += [(p, o, name, i, least) for o in range(blocks[p]) if (p, o) != (home, part)]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            pick = pa.array(columns[3], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()),
                    batch.column("v").take(pick), pa.array(columns[4], pa.int64()),
                ],
                names=["pivot", "part", "id", "v", "least"],
            )

    chunks = pieces(queries, QUERIES_PER_CHUNK)
    chunk = F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int")
    visits = asked.mapInArrow(routes, "pivot int, part int, id long, v array<bigint>, least long").withColumn("chunk", chunk)
    held = placed.select("pivot", "part", "id", "v", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))

    def away(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _found([])
        tree, rows = Tree(left.column("id").to_numpy(), _matrix(left.column("v"), width), most), []
        for name, q, least in zip(
            right.column("id").to_pylist(), _matrix(right.column("v"), width), right.column("least").to_pylist(), strict=True
        ):
            rows += [(name, other, score) for score, other in tree.search(q, k, name, least)]
        return _found(rows)

    keys = ("pivot", "part", "chunk")
    held, visits = (side.repartition(tasks * chunks, *keys) for side in (held, visits))
    others = held.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInArrow(away, FOUND)
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        local.unionByName(others)
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
