"""Exact top-k search by inner product, with pivot-table elimination.

Vectors become integers, floor(scale * x). With one more coordinate sqrt(M - |x|^2), M the largest
squared norm, all candidates lie on one sphere and the inner product falls as the distance to
the query (whose extra coordinate is 0) grows. Distances of all candidates to `pivots`
far-apart pivots are computed once and written: the pivot table. For a query, the
largest |d(q, p) - d(x, p)| over the pivots bounds its distance to x from below, hence the
score from above. Candidates are evaluated in the order of this bound until the next
bound is below the k-th score found so far; the first k-th score comes from the sample that the
pivots are drawn from.

Queries go in blocks of `query_block`, each block against all rows in one scan of the
pivot table; a block's vectors are all that is broadcast. A task keeps k candidates a query, and the k best of
the tasks' are the result. Bounds are rounded outwards, scores are whole numbers: the result is exact.

Defined cases: vectors that are null or hold a null or a non-finite component take no part, nor do rows
without an id; vectors of unequal length are compared as if the shorter ended in zeros; all rows with the
query's id are its own; equal query rows are asked once; repeated candidates count each; fewer than k
candidates are all returned; scores beyond 64 bits are cut to the largest or smallest long; no
vector or no query gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaar.llm.common import materialize

RESULT = "query_id long, q long, vec_id long, score long"
STEP = 256


def whole(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def usable(vector: Column) -> Column:
    """No null and no non-finite component, and not null itself."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                    & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def _matrix(vectors, dim: int) -> np.ndarray:
    """The vectors as rows of floats, which are exact up to 2 ** 53; else as Python's whole numbers."""
    rows = [np.asarray(v, dtype=np.int64) for v in vectors]
    out = np.zeros((len(rows), dim), dtype=np.int64)
    for i, v in enumerate(rows):
        out[i, :len(v)] = v
    return out


def _exact(limit: float, x: np.ndarray) -> np.ndarray:
    return x.astype(np.float64) if limit < 2 ** 52 else x.astype(object)


def _long(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object:
        return np.array([min(max(int(s), -2 ** 63), 2 ** 63 - 1) for s in scores], dtype=np.int64)
    return scores.astype(np.int64)


def _distances(x: np.ndarray, pivots: np.ndarray, top: float, query: bool) -> np.ndarray:
    """Distances on the sphere of candidates, or of queries to it."""
    x, p = x.astype(np.float64), pivots.astype(np.float64)
    norm = (x * x).sum(axis=1)
    dots = x @ p.T
    if not query:
        p_extra = np.sqrt(np.maximum(top - (p * p).sum(axis=1), 0))
        dots += np.sqrt(np.maximum(top - norm, 0))[:, None] * p_extra[None, :]
        norm = np.full(len(x), top)
    return np.sqrt(np.maximum(norm[:, None] + top - 2 * dots, 0))


def _far_apart(sample: np.ndarray, pivots: int, top: float) -> np.ndarray:
    """Farthest-first choice among the sample, from its first row on; equal vectors are chosen once."""
    chosen = [0]
    far = _distances(sample, sample[:1], top, False)[:, 0]
    while len(chosen) < pivots:
        i = int(far.argmax())
        if far[i] <= 1e-6 * np.sqrt(max(top, 1)):
            break
        chosen.append(i)
        far = np.minimum(far, _distances(sample, sample[i:i + 1], top, False)[:, 0])
    return sample[chosen]


class _Best:
    """The k best (score, id) of one query: scores falling, ties by smaller id."""

    def __init__(self, k: int, floor):
        self.k, self.floor = k, floor
        self.scores = np.empty(0, dtype=object if isinstance(floor, int) else np.float64)
        self.ids = np.empty(0, dtype=np.int64)

    def bar(self):
        """What a candidate must reach to matter."""
        return max(self.floor, self.scores[-1]) if len(self.scores) == self.k else self.floor

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        take = scores >= self.bar()
        s, i = np.concatenate([self.scores, scores[take]]), np.concatenate([self.ids, ids[take]])
        order = np.lexsort((i, -s.astype(np.float64))) if s.dtype != object else np.array(
            sorted(range(len(s)), key=lambda a: (-s[a], i[a])), dtype=np.int64)
        self.scores, self.ids = s[order[:self.k]], i[order[:self.k]]


def _scan(block, k: int, top: float, dim: int, limit: float, rows: int):
    """Run a block of queries (ids, keys, vectors, floors, pivot distances) over a partition of the pivot table."""

    def evaluate(best: list[_Best], frames: list[pd.DataFrame]) -> None:
        q = block.value
        frame = pd.concat(frames, ignore_index=True)
        ids = frame["id"].to_numpy(dtype=np.int64)
        x = _exact(limit, _matrix(frame["v"], dim))
        dx = np.stack(list(frame["d"].map(np.asarray))).astype(np.float32)
        qx = _exact(limit, q["vectors"])
        slack = 2e-6 * np.sqrt(max(top, 1)) + 1e-6 * float(q["d"].max(initial=0))
        for at in range(0, len(q["ids"]), 64):
            dq = q["d"][at:at + 64].astype(np.float32)
            low = np.zeros((len(dq), len(ids)), dtype=np.float32)
            for p in range(dx.shape[1]):
                np.maximum(low, np.abs(dq[:, p, None] - dx[None, :, p]), out=low)
            low = np.maximum(low.astype(np.float64) - slack, 0)
            most = (q["norm"][at:at + 64, None] + top - low * low) / 2
            most += 1e-9 * (q["norm"][at:at + 64, None] + top) + 1
            for r in range(len(dq)):
                b, bound = best[at + r], most[r]
                left = np.flatnonzero((bound >= float(b.bar())) & (ids != q["ids"][at + r]))
                left = left[np.argsort(-bound[left], kind="stable")]
                for lo in range(0, len(left), STEP):
                    if bound[left[lo]] < float(b.bar()):
                        break
                    some = left[lo:lo + STEP]
                    b.add(x[some] @ qx[at + r], ids[some])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q = block.value
        best = [_Best(k, f) for f in q["floors"]]
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += len(b)
            if n >= rows:
                evaluate(best, held)
                held, n = [], 0
        if n:
            evaluate(best, held)
        for at in range(0, len(best), 256):
            some = best[at:at + 256]
            yield pd.DataFrame({
                "query_id": np.repeat(q["ids"][at:at + 256], [len(b.ids) for b in some]),
                "q": np.repeat(q["keys"][at:at + 256], [len(b.ids) for b in some]),
                "vec_id": np.concatenate([b.ids for b in some]),
                "score": np.concatenate([_long(b.scores) for b in some])})
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, pivots: int = 32,
          sample_rows: int = 1024, query_block: int = 4096, rows: int = 4096, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k best candidates."""
    spark = vectors.sparkSession
    base = vectors.filter(F.col(id_col).isNotNull() & usable(F.col(vec_col))).select(
        F.col(id_col).cast("long").alias("id"), whole(F.col(vec_col), scale).alias("v"), is_query.alias("asked"))
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    stats = base.agg(F.max(F.size("v")).alias("dim"), F.max(norm).alias("top"),
                     F.count(F.when(F.col("asked"), 1)).alias("asked")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not stats["asked"]:
        return empty
    dim, top, limit = max(stats["dim"], 1), float(stats["top"]), float(stats["top"]) * 4
    drawn = base.select("id", "v").orderBy(F.xxhash64("id", "v"), "id").limit(sample_rows).collect()
    sample_ids = np.array([r["id"] for r in drawn], dtype=np.int64)
    sample = _matrix([r["v"] for r in drawn], dim)
    own_pivots = _far_apart(sample, pivots, top)

    @F.pandas_udf("array<float>")
    def to_pivots(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for v in parts:
            d = _distances(_matrix(v, dim), own_pivots, top, False).astype(np.float32)
            yield pd.Series(list(d), dtype="object")

    table = materialize(base.select("id", "v", "asked", to_pivots("v").alias("d")), "op1-pivots")
    blocks = stats["asked"] // query_block + 1
    asked = table.filter("asked").select("id", "v", F.xxhash64("v").alias("key")).distinct()
    asked = materialize(asked.withColumn("block", F.pmod(F.xxhash64("id", "key"), F.lit(blocks))), "op1-queries")
    found = []
    for i in range(blocks):
        own = asked.filter(F.col("block") == i).orderBy("id", "key").collect()
        if not own:
            continue
        q = _matrix([r["v"] for r in own], dim)
        ids = np.array([r["id"] for r in own], dtype=np.int64)
        scores = _exact(limit, q) @ _exact(limit, sample).T
        lowest = -2 ** 200 if scores.dtype == object else -np.inf
        floors = []
        for r in range(len(own)):
            others = np.sort(scores[r][sample_ids != ids[r]])
            floors.append(others[-k] if len(others) >= k else lowest)
        as_floats = q.astype(np.float64)
        block = spark.sparkContext.broadcast({
            "ids": ids, "keys": np.array([r["key"] for r in own], dtype=np.int64), "vectors": q, "floors": floors,
            "norm": (as_floats * as_floats).sum(axis=1), "d": _distances(q, own_pivots, top, True)})
        scan = table.select("id", "v", "d").mapInPandas(_scan(block, k, top, dim, limit, rows), RESULT)
        found.append(scan if blocks == 1 else materialize(scan, "op1-found"))
    rank = F.row_number().over(Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id"))
    return (reduce(DataFrame.unionByName, found).withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM s QUALIFY rank <= 10
"""
