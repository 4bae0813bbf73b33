"""Exact top-k search by inner product: a Voronoi join of queries and vectors.

Vectors are grouped by their nearest pivot. A group's summary (size, radius) bounds every score in it: for a member x of
pivot p, q.x <= q.p + |q| * radius. A query goes only to the groups whose bound reaches a score that it is sure to get k
times over, and each group is solved by itself. Groups are cut into blocks of bounded size, and so are their queries.
Of vectors that are equal only the k + 1 smallest ids can be in a result, so a vector that a third of all rows share
is thinned before anything else. Pivots are a bounded sample and only steer the grouping.

Null vectors and ids, and vectors with null or non-finite components, take no part. Vectors meet those of their own
length. Rows that repeat an id and a vector count once. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmeter.llm.common import arrow_map, stored

#: Pivots at most; below that, the root of the number of vectors.
PIVOTS = 4096
#: Vectors and queries that meet in one task step, about.
BLOCK, QUERIES = 512, 8192


def whole_numbers(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """id and floor(256 * x) of every component, for the vectors that take part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias(vector))
    rows = rows.where(F.col("id").isNotNull() & F.col(vector).isNotNull()).where(~bad)
    return rows.select("id", F.transform(vector, lambda x: F.floor(x * 256.0)).alias("x"))


def _packed(column: pa.Array) -> tuple[list[bytes], np.ndarray]:
    """Each list as bytes of doubles, and its length."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("<f8")
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    raw = flat.tobytes()
    return [raw[8 * a : 8 * b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], sizes


class Pivots:
    """Pivot vectors by length, and after summarise() the size and radius of each group."""

    def __init__(self, rows: list[list[int]], ids: list[int]):
        self.at: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for n in sorted({len(r) for r in rows}):
            own = [i for i, r in enumerate(rows) if len(r) == n]
            self.at[n] = np.array([rows[i] for i in own], float).reshape(len(own), n), np.array([ids[i] for i in own]), np.array(own)
        self.size: dict[tuple[int, int], int] = {}
        self.radius: dict[tuple[int, int], float] = {}

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Group and distance to its pivot; -1 if there is no pivot of this length."""
        if x.shape[1] not in self.at:
            return np.full(len(x), -1), np.zeros(len(x))
        pivots, _, own = self.at[x.shape[1]]
        far = (x**2).sum(1)[:, None] - 2 * x @ pivots.T + (pivots**2).sum(1)
        best = far.argmin(1)
        return own[best], np.sqrt(((x - pivots[best]) ** 2).sum(1))

    def reached(self, q: np.ndarray, query_id: int, k: int) -> list[int]:
        """The groups that may hold one of the k best of q."""
        n = len(q)
        groups = [g for length, g in self.size if length == n]
        if n not in self.at:
            return groups
        pivots, ids, own = self.at[n]
        scores, norm = pivots @ q, float(np.sqrt(q @ q))
        sure = np.sort(scores[ids != query_id])[::-1]
        least = sure[k - 1] if len(sure) >= k else -math.inf
        bound = dict(zip(own.tolist(), scores.tolist(), strict=True))
        reach = {g: bound[g] + norm * self.radius[n, g] if g in bound else math.inf for g in groups}
        return [g for g in groups if reach[g] * (1 + 1e-12) + 1e-6 >= least]


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, the key column and score; ties go to the smaller id. `is_query` is on the column `id`."""
    rows = whole_numbers(vectors, key, vector)
    rank = F.dense_rank().over(Window.partitionBy("x").orderBy("id"))
    kept = rows.withColumn("rank", rank).where(F.col("rank") <= k + 1).drop("rank").dropDuplicates(["x", "id"])
    kept = stored(kept, "topk-vectors")
    many = kept.count()
    sample = kept.orderBy(F.xxhash64("x"), "id").limit(min(PIVOTS, max(16, math.isqrt(many)))).collect()
    pivots = Pivots([r["x"] for r in sample], [r["id"] for r in sample])

    def make():
        def work(batch: pa.RecordBatch):
            ids = batch.column(0).to_numpy()
            raw, sizes = _packed(batch.column(1))
            for n in np.unique(sizes).tolist():
                pick = np.flatnonzero(sizes == n)
                own = [raw[i] for i in pick]
                x = np.frombuffer(b"".join(own), "<f8").reshape(len(pick), n)
                group, far = pivots.nearest(x)
                arrays = [pa.array(ids[pick]), pa.array(own, pa.binary()), pa.array([n] * len(pick), pa.int32())]
                arrays += [pa.array(group, pa.int32()), pa.array(far, pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "x", "length", "cell", "far"])

        return work

    placed = stored(arrow_map(kept, "id long, x binary, length int, cell int, far double", make), "topk-cells")
    for r in placed.groupBy("length", "cell").agg(F.count("*").alias("many"), F.max("far").alias("radius")).collect():
        pivots.size[r["length"], r["cell"]] = r["many"]
        pivots.radius[r["length"], r["cell"]] = r["radius"]

    queries = rows.where(is_query).dropDuplicates(["id", "x"])
    parts = -(-queries.count() // QUERIES) or 1

    def route():
        def work(batch: pa.RecordBatch):
            out: list[list] = [[], [], [], [], []]
            raw, sizes = _packed(batch.column(1))
            for query_id, x, n in zip(batch.column(0).to_pylist(), raw, sizes.tolist(), strict=True):
                for g in pivots.reached(np.frombuffer(x, "<f8"), query_id, k):
                    for b in range(blocks(n, g)):
                        for column, value in zip(out, (query_id, x, n, g, b), strict=True):
                            column.append(value)
                    if len(out[0]) > 20_000:
                        yield send(out)
                        out = [[], [], [], [], []]
            yield send(out)

        return work

    def send(out: list[list]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32()]
        names = ["query_id", "q", "length", "cell", "block"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)

    def blocks(n: int, g: int) -> int:
        return -(-pivots.size[n, g] // BLOCK)

    routed = arrow_map(queries, "query_id long, q binary, length int, cell int, block int", route)
    routed = routed.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int"))
    cells = sorted(pivots.size)
    if not cells:
        return rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias(key), F.col("id").alias("score"))
    sizes = {c: blocks(*c) for c in cells}

    def cut():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            many = [sizes[n, g] for n, g in zip(batch.column("length").to_pylist(), batch.column("cell").to_pylist(), strict=True)]
            block = batch.column("spot").to_numpy() % np.array(many, np.int64)
            return batch.set_column(batch.schema.get_field_index("spot"), "block", pa.array(block, pa.int32()))

        return work

    spots = placed.select("id", "x", "length", "cell", F.pmod(F.xxhash64("id", "x"), F.lit(1 << 40)).alias("spot"))
    data = arrow_map(spots, "id long, x binary, length int, cell int, block int", cut)
    data = data.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def solve(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(asked):
            return pd.DataFrame({"query_id": [], "q": [], "id": [], "score": []})
        own = own.sort_values("id")
        x = np.frombuffer(b"".join(own["x"]), "<f8").reshape(len(own), -1)
        ids, found = own["id"].to_numpy(), []
        for a in range(0, len(asked), 256):
            some = asked.iloc[a : a + 256]
            q = np.frombuffer(b"".join(some["q"]), "<f8").reshape(len(some), -1)
            scores = q @ x.T if q.shape[1] else np.zeros((len(q), len(x)))
            scores[some["query_id"].to_numpy()[:, None] == ids[None, :]] = -np.inf
            best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            value = np.take_along_axis(scores, best, 1)
            row, col = np.nonzero(np.isfinite(value))
            found.append(
                pd.DataFrame(
                    {
                        "query_id": some["query_id"].to_numpy()[row],
                        "q": some["q"].to_numpy()[row],
                        "id": ids[best[row, col]],
                        "score": value[row, col].astype(np.int64),
                    }
                )
            )
        return pd.concat(found)

    by = ["length", "cell", "block", "part"]
    solved = data.groupBy(*by).cogroup(routed.groupBy(*by)).applyInPandas(solve, "query_id long, q binary, id long, score long")
    solved = solved.withColumn("q", F.xxhash64("q"))
    best = F.row_number().over(Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "id"))
    found = solved.withColumn("rank", best).where(F.col("rank") <= k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(key), "score")
