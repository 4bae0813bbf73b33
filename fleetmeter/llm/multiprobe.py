"""Approximate nearest neighbours by inner product: p-stable hashing, many probes a table, exact distances at the end.

A table has a few hash functions floor((a.x + b) / width) with Gaussian a; together their slots name a bucket. Every
vector is in one bucket of each table. A query visits buckets in the order of the estimated chance that they hold its
k-th neighbour. If that neighbour has inner product s with the query q and norm n, its projection is Gaussian around
s * (a.q) / |q|**2 with variance n**2 - s**2 / |q|**2, so a slot's chance is a difference of two normal distribution values and a
bucket's chance the product over its slots. s and n are read off the query's products with a bounded sample. A query stops in a table once
the chances add up to what the table owes to the `found` share over all tables: near or clustered neighbours need few
probes, vectors without any structure need most buckets. Nothing else limits probes or candidates.

Buckets are dealt to shares of about SHARE vectors; what a share holds beyond that is cut into blocks, and queries beyond
ASKED into parts, so no task gets an unbounded group. A cell sends one row a query with its best k, scored exactly; these
merge in two steps, so no group of a query is long.
Of equal vectors only the k + 1 smallest ids can be in a result; more are not hashed. A query that found less than k is
answered from all buckets.

Null ids, and vectors that are null, empty, zero or have null or non-finite components, take no part. Vectors meet those of their own
length, one length after the other. Rows that repeat an id and a vector count once. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmeter.llm.common import finite_vectors, list_matrix, mix, stored

#: Hash tables, vectors in an average bucket, and the width of a slot in standard deviations of a projection.
TABLES, BUCKET, WIDTH = 2, 48, 2.0
#: Share of the k-th neighbours that the probes are to reach.
FOUND = 0.97
#: Vectors of the sample from which a query's neighbours are estimated; the only thing that is not read from all rows.
SAMPLE = 2048
#: Vectors in a share, queries that meet them at a time.
SHARE, ASKED = 4096, 16384
#: Queries whose probes one task works out; groups in which a query's results first merge.
PROBED, MERGES = 512, 32
#: Queries that a cell answers at a time; places a query that are held, as a multiple of k, before its k-th best is looked up.
TOGETHER, HELD = 512, 8
#: Bits that one slot adds to a bucket's name, at WIDTH.
_BITS = 1.2

_erf = np.vectorize(math.erf, otypes=[float])


def _normal(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + _erf(x / math.sqrt(2)))


def likeliest(chances: list[np.ndarray], keys: list[np.ndarray], owed: float) -> tuple[np.ndarray, np.ndarray]:
    """Chances and keys of combinations, one item of each list, by falling chance until these add up to `owed`.

    A chance is the product, a key the wrapping sum. Combinations below a bound that sinks step by step are cut while
    they are built; if all there are add up to less, all are given.
    """
    rest = np.cumprod([c.max() for c in chances][::-1])[::-1].tolist() + [1.0]
    least = rest[0]
    while True:
        least = least / 8 if least > 1e-12 else 0.0
        p, k = np.ones(1), np.zeros(1, np.uint64)
        for j, (c, key) in enumerate(zip(chances, keys, strict=True)):
            whole = p[:, None] * c[None, :]
            pick = np.nonzero(whole * rest[j + 1] >= least)
            p, k = whole[pick], k[pick[0]] + key[pick[1]]
        order = np.lexsort((k, -p))
        total = np.cumsum(p[order])
        enough = int(np.searchsorted(total, owed)) + 1
        if enough <= len(p) or not least:
            return p[order[:enough]], k[order[:enough]]


class Tables:
    """The hash functions of all tables, and the sample. `many` is the number of vectors that are hashed."""

    def __init__(self, sample: np.ndarray, many: int, dims: int, tables: int = 0, seed: int = 13):
        tables = tables or TABLES
        rng = np.random.default_rng(seed)
        self.sample, self.norm = sample, np.sqrt((sample**2).sum(1))
        spread = math.sqrt(float((sample**2).mean(1).mean()) * dims) or 1.0
        self.width = WIDTH * spread
        self.many, self.tables = many, tables
        self.functions = max(1, round(math.log2(max(2, many / BUCKET)) / _BITS))
        self.a = rng.standard_normal((tables, self.functions, dims))
        self.b = rng.uniform(0, self.width, (tables, self.functions))
        self.odd = rng.integers(0, 1 << 62, (tables, self.functions), np.uint64) * np.uint64(2) + np.uint64(1)
        self.shares = max(1, -(-many // SHARE))

    def share(self, table: int, keys: np.ndarray) -> np.ndarray:
        return (mix(keys) % np.uint64(self.shares)).astype(np.int64) + table * self.shares

    def keys(self, table: int, x: np.ndarray) -> np.ndarray:
        """Bucket of each vector."""
        slots = np.floor((x @ self.a[table].T + self.b[table]) / self.width).astype(np.int64).view(np.uint64)
        return (slots * self.odd[table]).sum(1, dtype=np.uint64)

    def neighbour(self, q: np.ndarray, k: int) -> tuple[float, float]:
        """Inner product and norm of about the k-th neighbour of q, from its neighbours in the sample."""
        products = self.sample @ q
        products[(self.sample == q).all(1)] = -np.inf
        order = np.argsort(-products, kind="stable")[: max(1, math.ceil(k * len(products) / max(1, self.many)))]
        s = products[order[-1]]
        return (float(s), float(self.norm[order].max())) if np.isfinite(s) else (0.0, float(self.norm.max(initial=1.0)))

    def probes(self, q: np.ndarray, k: int, found: float) -> list[np.ndarray]:
        """For each table, the buckets that q visits, in order."""
        s, norm = self.neighbour(q, k)
        square = float(q @ q)
        spread = math.sqrt(max(norm**2 - s * s / square, 1e-6 * norm**2))
        owed = 1 - (1 - found) ** (1 / self.tables)
        out = []
        for t in range(self.tables):
            middle = (self.a[t] @ q) * s / square + self.b[t]
            low = np.floor((middle - 4 * spread) / self.width).astype(np.int64)
            high = np.floor((middle + 4 * spread) / self.width).astype(np.int64)
            chances, keys = [], []
            for j in range(self.functions):
                edges = np.arange(low[j], high[j] + 2)
                chances.append(np.maximum(np.diff(_normal((edges * self.width - middle[j]) / spread)), 1e-12))
                keys.append(edges[:-1].view(np.uint64) * self.odd[t, j])
            out.append(likeliest(chances, keys, owed)[1])
        return out


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, added up from the first component to the last."""
    total = np.zeros(len(q))
    for j in range(q.shape[1]):
        total += q[:, j] * x[:, j]
    return total


def _best(query: np.ndarray, score: np.ndarray, tie: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best, by falling score and then `tie`."""
    order = np.lexsort((tie, -score, query))
    new = np.flatnonzero(np.diff(query[order], prepend=-1))
    rank = np.arange(len(order)) - np.repeat(new, np.diff(np.append(new, len(order))))
    return order[rank < k]


class _Held:
    """Places that may be among a query's k best: those within `near` of the k-th best product that it has met so far."""

    def __init__(self, near: np.ndarray, k: int):
        self.near, self.k = near, k
        self.least, self.many = np.full(len(near), -np.inf), 0  # many: places since the last look
        self.rows: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.values: list[np.ndarray] = []

    def add(self, who: np.ndarray, first: int, value: np.ndarray) -> None:
        """Products of the queries `who` with the vectors from place `first` on; -inf for the query's own."""
        least, k, size = self.least[who], self.k, value.shape[1]
        keep = (value >= least[:, None]) & (value > -np.inf)
        many = np.flatnonzero(keep.sum(1) > k)
        if len(many):
            edge = np.partition(value[many], size - k, axis=1)[:, size - k]
            keep[many] &= value[many] >= (edge - self.near[who[many]])[:, None]
        r, c = np.nonzero(keep)
        self.rows.append(who[r])
        self.places.append(first + c)
        self.values.append(value[r, c])
        self.many += len(r)
        if self.many > HELD * k * len(self.near):
            self._thin()

    def _thin(self) -> None:
        r, c, v = (np.concatenate(x) for x in (self.rows, self.places, self.values))
        top = _best(r, v, c, self.k)
        last = np.flatnonzero(np.diff(r[top], append=-1))
        full = np.bincount(r[top], minlength=len(self.near))[r[top][last]] == self.k
        row = r[top][last][full]
        self.least[row] = v[top][last][full] - self.near[row]
        stay = v >= self.least[r]
        self.rows, self.places, self.values = [r[stay]], [c[stay]], [v[stay]]
        self.many = 0

    def best(self) -> tuple[np.ndarray, np.ndarray]:
        """Queries and places that are left."""
        if not self.rows:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        self._thin()
        return self.rows[0], self.places[0]


def _solver(k: int):
    """Of the vectors and queries of a cell, each query's k best in the buckets that it visits (null: all of them)."""

    def work(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "row": [], "ids": [], "scores": []}, dtype=object)
        if not len(own) or not len(asked):
            return empty
        own = own.sort_values(["bucket", "id"])
        bucket, ids = own["bucket"].to_numpy().view(np.uint64), own["id"].to_numpy()
        x = np.frombuffer(b"".join(own["x"]), "<f8").reshape(len(own), -1)
        order = np.argsort(bucket, kind="stable")
        bucket, ids, x = bucket[order], ids[order], x[order]
        start = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        name, end = bucket[start], np.append(start[1:], len(bucket))
        slack = 1e-9 * float(np.sqrt((x**2).sum(1).max()))
        out = []
        for a in range(0, len(asked), TOGETHER):
            some = asked.iloc[a : a + TOGETHER]
            q = np.frombuffer(b"".join(some["q"]), "<f8").reshape(len(some), -1)
            query_id, near = some["query_id"].to_numpy(), slack * np.sqrt((q**2).sum(1))
            asks = np.isin(ids, query_id)
            visits = [name if v is None else np.frombuffer(v, "<u8") for v in some["buckets"]]
            flat, by = np.concatenate(visits), np.repeat(np.arange(len(visits)), [len(v) for v in visits])
            at = np.minimum(np.searchsorted(name, flat), len(name) - 1)
            hit = name[at] == flat
            at, by = at[hit], by[hit]
            order = np.lexsort((by, at))
            at, by = at[order], by[order]
            cut = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1], [True]])) if len(at) else []
            held = _Held(near, k)
            for lo, hi in zip(cut[:-1], cut[1:], strict=True):
                s, e, who = start[at[lo]], end[at[lo]], by[lo:hi]
                value = q[who] @ x[s:e].T
                if asks[s:e].any():
                    value[query_id[who][:, None] == ids[None, s:e]] = -np.inf
                held.add(who, s, value)
            r, c = held.best()
            if not len(r):
                continue
            exact = scores(q[r], x[c])
            best = _best(r, exact, ids[c], k)
            if not len(best):
                continue
            r, c, exact = r[best], c[best], exact[best]
            cut = np.flatnonzero(np.diff(r, prepend=-1))
            sent = {"query_id": query_id[r[cut]], "row": some["row"].to_numpy()[r[cut]]}
            sent |= {"ids": np.split(ids[c], cut[1:]), "scores": np.split(exact, cut[1:])}
            out.append(pd.DataFrame(sent))
        return pd.concat(out) if out else empty

    return work


def _bytes_of(x: np.ndarray) -> list[bytes]:
    return [r.tobytes() for r in np.ascontiguousarray(x, "<f8")]


def _placed(rows: DataFrame, tables: Tables) -> DataFrame:
    """share, bucket, id and x of every vector in every table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = list_matrix(batch.column(1), float)
            packed = pa.array(_bytes_of(x), pa.binary())
            for t in range(tables.tables):
                keys = tables.keys(t, x)
                arrays = [pa.array(tables.share(t, keys)), pa.array(keys.view(np.int64)), batch.column(0), packed]
                yield pa.RecordBatch.from_arrays(arrays, ["share", "bucket", "id", "x"])

    return rows.select("id", "x").mapInArrow(run, "share long, bucket long, id long, x binary")


def _asked(queries: DataFrame, tables: Tables, k: int, found: float, everywhere: bool = False) -> DataFrame:
    """share, query_id, row (a name of the query's vector), q and the buckets that it visits there, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = list_matrix(batch.column(2), float)
            out: list[list] = [[], [], [], [], []]
            for query_id, row, q, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), x, _bytes_of(x), strict=True):
                if everywhere:
                    visits = [(s, None) for s in range(tables.shares)]  # every vector is in each table
                else:
                    visits = []
                    for t, keys in enumerate(tables.probes(q, k, found)):
                        share = tables.share(t, keys)
                        order = np.argsort(share, kind="stable")
                        cut = np.flatnonzero(np.diff(share[order], prepend=-1, append=-1))
                        visits += [(int(share[order[a]]), keys[order[a:b]].tobytes()) for a, b in zip(cut[:-1], cut[1:], strict=True)]
                for share, buckets in visits:
                    for column, value in zip(out, (share, query_id, row, packed, buckets), strict=True):
                        column.append(value)
                if len(out[0]) > 10_000:
                    yield sent(out)
                    out = [[], [], [], [], []]
            yield sent(out)

    def sent(out: list[list]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["share", "query_id", "row", "q", "buckets"])

    return queries.select("id", "row", "x").mapInArrow(run, "share long, query_id long, row long, q binary, buckets binary")


def _met(placed: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """query_id, row, ids and scores of each query's best in each cell of vectors and queries."""
    blocks = placed.groupBy("share").agg(F.ceil(F.count("*") / SHARE).cast("int").alias("blocks"))
    parts = asked.groupBy("share").agg(F.ceil(F.count("*") / ASKED).cast("int").alias("parts"))
    grid = stored(blocks.join(parts, "share"), "probe-grid")
    one = lambda name, *by: F.pmod(F.xxhash64(*by), F.col(name)).cast("int")
    every = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    data = placed.join(grid, "share").withColumn("block", one("blocks", "id", "bucket")).withColumn("part", every("parts"))
    rows = asked.join(grid, "share").withColumn("part", one("parts", "query_id", "row")).withColumn("block", every("blocks"))
    by = ["share", "block", "part"]
    data, rows = data.select(*by, "bucket", "id", "x"), rows.select(*by, "query_id", "row", "q", "buckets")
    schema = "query_id long, row long, ids array<long>, scores array<double>"
    return data.groupBy(*by).cogroup(rows.groupBy(*by)).applyInPandas(lambda own, some: _solver(k)(own, some), schema)


def _merged(met: DataFrame, k: int) -> DataFrame:
    """query_id, row and best: (-score, id) of the k best of all cells, each once, in order."""
    pairs = F.arrays_zip("scores", "ids")
    best = F.transform(pairs, lambda x: F.struct((-x["scores"]).alias("far"), x["ids"].alias("id")))
    group = F.pmod(F.xxhash64("ids"), F.lit(MERGES))
    rows = met.select("query_id", "row", group.alias("group"), best.alias("best"))
    for by in (["query_id", "row", "group"], ["query_id", "row"]):
        rows = rows.groupBy(*by).agg(F.sort_array(F.flatten(F.collect_list("best"))).alias("whole"))
        # equal ones lie side by side: array_distinct would compare each with each
        once = F.filter("whole", lambda x, i: (i == 0) | (x != F.get("whole", i - 1)))
        rows = rows.select(*by, F.slice(once, 1, k).alias("best"))
    return rows


def _search(rows: DataFrame, is_query: Column, k: int, dims: int, found: float, tables: int) -> DataFrame:
    """The search among vectors of one length."""
    order = F.row_number().over(Window.partitionBy("x").orderBy("id"))
    kept = rows.dropDuplicates(["id", "x"]).withColumn("copy", order).where(F.col("copy") <= k + 1).select("id", "x")
    kept = stored(kept, "probe-vectors")
    many = kept.count()
    some = kept.withColumn("spot", F.pmod(F.xxhash64("x", "id"), F.lit(1 << 40)))
    some = some.where(F.col("spot") < int((1 << 40) * min(1, 2 * SAMPLE / max(1, many)))).orderBy("spot", "id").limit(SAMPLE)
    sample = np.array([r["x"] for r in some.select("x").collect()], float).reshape(-1, dims)
    model = Tables(sample, many, dims, tables)
    placed = stored(_placed(kept, model), "probe-buckets")
    queries = rows.where(is_query).dropDuplicates(["id", "x"]).withColumn("row", F.xxhash64("x"))
    queries = stored(queries.select("id", "row", "x"), "probe-queries")
    spread = queries.repartition(max(1, -(-queries.count() // PROBED)), "id", "row")
    asked = stored(_asked(spread, model, k, found), "probe-visits")
    met = stored(_merged(_met(placed, asked, k), k), "probe-found")
    counts = met.select(F.col("query_id").alias("id"), "row", F.size("best").alias("have"))
    few = queries.join(counts, ["id", "row"], "left").where(F.coalesce("have", F.lit(0)) < k)
    few = stored(few.select("id", "row", "x"), "probe-short")
    if not few.isEmpty():
        again = _merged(_met(placed, _asked(few, model, k, found, everywhere=True), k), k)
        met = met.join(few.select(F.col("id").alias("query_id"), "row"), ["query_id", "row"], "left_anti").unionByName(again)
    ranked = met.select("query_id", F.posexplode("best").alias("place", "one"))
    return ranked.select("query_id", (F.col("place") + 1).alias("rank"), F.col("one.id").alias("id"), (F.lit(0.0) - F.col("one.far")).alias("score"))


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    found: float = FOUND,
    tables: int = TABLES,
) -> DataFrame:
    """query_id, rank, the key column and score of each query's k nearest found. `is_query` is on the column `id`."""
    rows = finite_vectors(vectors, key, vector).where(F.col("id").isNotNull() & F.exists("x", lambda x: x != 0.0))
    lengths = sorted(r[0] for r in rows.select(F.size("x")).distinct().collect())
    parts = [_search(rows.where(F.size("x") == n), is_query, k, n, found, tables) for n in lengths]
    if not parts:
        return vectors.sparkSession.createDataFrame([], f"query_id long, rank int, {key} long, score double")
    return reduce(DataFrame.unionByName, parts).withColumnRenamed("id", key)
