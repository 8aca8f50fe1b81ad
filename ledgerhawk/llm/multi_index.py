"""Approximate nearest neighbours by cosine with an inverted multi-index.

Unit vectors are cut into two halves, each quantised with a codebook of its own;
a cell is a pair of centroids. Codebooks are fitted on a bounded sample
(``SAMPLE`` vectors, by hash); every vector is indexed. For a query the
centroid pairs are walked by growing summed distance with a heap (multi-sequence
order) until they hold ``VISIT_SHARE`` of the vectors (``MIN_VISIT`` at least). The
summed distance reached is the query's bound: it visits every cell up to it.

Rows are grouped by their first centroid and cut into blocks of about ``BLOCK``
rows, the queries that visit such a group into blocks too, so a very common vector
or a popular cell is many bounded tasks. A block computes similarities in one
product, masks the cells a query does not visit, and reranks what can reach the
``k`` best with the exact cosine of the original vectors.

Unclustered vectors need a large share for a given recall; lower
``visit_share`` for clustered ones. Recall is measured against brute force in the tests.

Defined cases: rows with a NULL vec_id (they cannot be named in a result), NULL, empty
and zero vectors, vectors holding NULL or a non-finite component, and vectors of
another length than the commonest one of the others take no part;
rows with the query's own vec_id are no candidates; ties go to the smaller
vec_id; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, prepared

CENTROIDS = 64
SAMPLE = 16_384
VISIT_SHARE, MIN_VISIT = 0.45, 400
BLOCK, QUERY_BLOCK = 4096, 512
_SLACK = 1e-9


def usable(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id, vec`` of the vectors that take part."""
    rows = prepared(embeddings, vec_id="bigint", **{column: "array<double>"}).withColumnRenamed(column, "vec")
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & ~F.coalesce(bad, F.lit(False)) & F.exists("vec", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.where(F.size("vec") == (sizes[0]["d"] if sizes else 0))


def kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 3) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = nearest(x, c)
        for j in np.unique(near):
            c[j] = x[near == j].mean(axis=0)
    return c


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ c.T + (c * c).sum(axis=1), 0)


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return _distances(x, c).argmin(axis=1)


def unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow of squares
    x = x / scale
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosines(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact cosine of each row with the query, added up alike for equal rows."""
    a, b = rows / np.abs(rows).max(axis=1, keepdims=True), query / np.abs(query).max()
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum()))


def visit_bound(first: np.ndarray, second: np.ndarray, counts: np.ndarray, want: int) -> float:
    """Summed distance up to which the centroid pairs, walked nearest first, hold ``want`` vectors."""
    i_order, j_order = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    a, b = first[i_order].tolist(), second[j_order].tolist()
    held, reached = 0, 0.0
    heap, depth = [(a[0] + b[0], 0, 0)], [0] * len(a)  # depth: pairs already walked of each row
    sizes = counts[np.ix_(i_order, j_order)].tolist()
    while heap and held < want:
        reached, i, j = heapq.heappop(heap)
        held += sizes[i][j]
        depth[i] = j + 1
        if j + 1 < len(b) and (i == 0 or depth[i - 1] > j + 1):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if i + 1 < len(a) and depth[i + 1] == j:
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
    return reached


def _stack(column) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, 0))


class MultiIndex:
    """``build`` fits the codebooks and writes the index; ``search`` queries it."""

    def __init__(self, books: tuple[np.ndarray, np.ndarray], rows: DataFrame, counts: np.ndarray):
        self.books, self.rows, self.counts = books, rows, counts

    @classmethod
    def build(cls, embeddings: DataFrame, centroids: int = CENTROIDS, sample: int = SAMPLE) -> MultiIndex | None:
        vectors = usable(embeddings)
        picked = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toPandas()
        if picked.empty:
            return None
        x = unit(_stack(picked["vec"]))
        half = max(1, x.shape[1] // 2)
        books = kmeans(x[:, :half], centroids), kmeans(x[:, half:], centroids)

        def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in frames:
                if len(pdf):
                    u = unit(_stack(pdf["vec"]))
                    yield pdf.assign(c1=nearest(u[:, :half], books[0]), c2=nearest(u[:, half:], books[1]))

        rows = keep(vectors.mapInPandas(assign, "vec_id long, vec array<double>, c1 int, c2 int"))
        counts = np.zeros((len(books[0]), len(books[1])), dtype=np.int64)
        for r in rows.groupBy("c1", "c2").count().collect():  # one row per cell at most
            counts[r["c1"], r["c2"]] = r["count"]
        return cls(books, rows, counts)

    def search(self, is_query: Column, k: int = 5, visit_share: float = VISIT_SHARE,
               min_visit: int = MIN_VISIT) -> DataFrame:
        """``query_id, rank, vec_id, score`` of the ``k`` nearest found for each indexed row that ``is_query`` picks."""
        books, counts = self.books, self.counts
        half = books[0].shape[1]
        want = max(min_visit, int(np.ceil(visit_share * counts.sum())))
        per_group = counts.sum(axis=1)

        def plan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            """A row per first centroid (and block of its rows) that a query visits."""
            for pdf in frames:
                if not len(pdf):
                    continue
                u = unit(_stack(pdf["vec"]))
                d1, d2 = _distances(u[:, :half], books[0]), _distances(u[:, half:], books[1])
                out = []
                for q, v, a, b in zip(pdf["vec_id"], pdf["vec"], d1, d2, strict=True):
                    bound = visit_bound(a, b, counts, want) + _SLACK
                    out += [(q, v, int(g), s, bound) for g in np.flatnonzero((a + b.min() <= bound) & (per_group > 0))
                            for s in range(-(-int(per_group[g]) // BLOCK))]
                yield pd.DataFrame(out, columns=["query_id", "qvec", "c1", "x_block", "bound"])

        picked = self.rows.where(is_query).select("vec_id", "vec").dropDuplicates(["vec_id"])
        # one file of many queries would be one task: deal them
        asked = picked.repartition(F.xxhash64("vec_id")) \
            .mapInPandas(plan, "query_id long, qvec array<double>, c1 int, x_block int, bound double")
        q_blocks = max(1, -(-picked.count() // QUERY_BLOCK))
        asked = asked.withColumn("q_block", F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)).cast("int"))
        blocks = F.element_at(F.array(*[F.lit(max(1, -(-int(n) // BLOCK))) for n in per_group]), F.col("c1") + 1)
        rows = self.rows.select("vec_id", "vec", "c1", "c2", F.pmod(F.xxhash64("vec_id", F.lit(1)), blocks)
                                .cast("int").alias("x_block")) \
            .withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))

        def rerank(x: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
            out = []
            if len(x) and len(q):
                x = x.sort_values("vec_id", kind="stable")
                ids, xs, qs = x["vec_id"].to_numpy(), _stack(x["vec"]), _stack(q["qvec"])
                ux, uq = unit(xs), unit(qs)
                reach = q["bound"].to_numpy() - _distances(uq[:, :half], books[0][x["c1"].iloc[:1]])[:, 0]
                seen = _distances(uq[:, half:], books[1])[:, x["c2"].to_numpy()] <= reach[:, None]
                near = np.where(seen & (q["query_id"].to_numpy()[:, None] != ids), uq @ ux.T, -np.inf)
                for i, query in enumerate(q["query_id"].to_numpy()):
                    line = near[i]
                    least = np.partition(line, len(line) - k)[len(line) - k] if len(line) > k else -np.inf
                    at = np.flatnonzero((line >= least - _SLACK) & (line > -np.inf))
                    score = cosines(xs[at], qs[i])
                    best = np.lexsort((ids[at], -score))[:k]
                    out += [(query, int(ids[at[b]]), float(score[b])) for b in best]
            return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

        keys = ["c1", "x_block", "q_block"]
        found = rows.groupBy(*keys).cogroup(asked.groupBy(*keys)) \
            .applyInPandas(rerank, "query_id long, vec_id long, score double")
        best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
            .select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(embeddings: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """The rows whose vec_id is divisible by ``every``, each with its ``k`` nearest found."""
    index = MultiIndex.build(embeddings)
    if index is None:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return index.search(F.col("vec_id") % every == 0, k)
