"""Product codes of vectors, learned and assigned with an integer Walsh-Hadamard transform.

Components become whole numbers, vectors are cut into equal parts, and each part position has a codebook that rounds of
assignment and averaging improve. To find the nearest entry of a part, part and entries are padded with zeros to a power
of two and transformed. The transform keeps squared distances but for the factor of the padded length, and it moves
most of a difference into the first coefficients. So squared differences are added up coefficient by coefficient, in
order of sequency, and an entry is out as soon as its sum passes the whole distance of a first guess. Everything is whole
numbers: sums are exact, ties go to the lower index.

A round is one job: each task adds up its own parts by entry, Spark adds the tasks', and the driver gets one row for each
(part, entry, place), `entries` times the length of a vector whatever the number of rows.

Vectors that are null or have a null or non-finite component are left out, and so are those whose length isn't a multiple
of the number of parts (or is 0) or differs from that of the smallest id that remains. Rows with a null id are coded, count
in averages and never start a codebook. Repeated rows count each; where a starting id repeats, its smallest vector is taken. With
fewer ids than entries the codebooks are as short. Labels may be of any type that groups; nulls are one label. Components too
large for exact 64-bit distances raise ValueError. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.llm.common import finite_vectors, list_matrix, stored

#: Rows whose distances are worked out at a time.
PASS_ROWS = 4096


def padded(length: int) -> int:
    """The least power of two that is not below `length`."""
    return 1 << max(0, length - 1).bit_length()


def sequency_order(size: int) -> np.ndarray:
    """Of each sequency, its place in the natural order of a transform of `size` coefficients."""
    bits = size.bit_length() - 1
    gray = np.arange(size) ^ (np.arange(size) >> 1)
    out = np.zeros(size, np.int64)
    for b in range(bits):
        out |= ((gray >> b) & 1) << (bits - 1 - b)
    return out


def transformed(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of whole numbers, in order of sequency; rows are padded with zeros."""
    size = padded(rows.shape[1])
    out = np.zeros((len(rows), size), np.int64)
    out[:, : rows.shape[1]] = rows
    step = 1
    while step < size:
        pairs = out.reshape(len(rows), -1, 2, step)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(rows), size)
        step *= 2
    return out[:, sequency_order(size)]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Of each transformed part: the nearest transformed entry (ties to the lower index), the squared distance times the
    number of coefficients, and how many squared differences were added up in all."""
    first = (parts[:, :1] - entries[None, :, 0]) ** 2
    guess = first.argmin(1)
    bound = ((parts - entries[guess]) ** 2).sum(1)
    row, entry = np.nonzero(first <= bound[:, None])
    total = first[row, entry]
    work = first.size + parts.size
    for s in range(1, parts.shape[1]):
        total = total + (parts[row, s] - entries[entry, s]) ** 2
        work += len(row)
        stay = total <= bound[row]
        if not stay.all():
            row, entry, total = row[stay], entry[stay], total[stay]
    whole = np.full(first.shape, np.iinfo(np.int64).max)
    whole[row, entry] = total
    best = whole.argmin(1)
    return best, whole[np.arange(len(parts)), best], work


class Codebooks:
    """Entries of each part position: whole numbers of shape (parts, entries, length of a part)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.coefficients = [transformed(e) for e in entries]

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry of each part of each vector, and the squared distances summed over the parts."""
        many, _, length = self.entries.shape
        code = np.empty((len(x), many), np.int64)
        error = np.zeros(len(x), np.int64)
        for a in range(0, len(x), PASS_ROWS):
            some = slice(a, a + PASS_ROWS)
            for p in range(many):
                parts = transformed(x[some, p * length : (p + 1) * length])
                code[some, p], scaled, _ = nearest(parts, self.coefficients[p])
                error[some] += scaled // parts.shape[1]
        return code, error

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def updated(books: Codebooks, rows: DataFrame) -> Codebooks:
    """The codebooks after a round: each entry the rounded-down average of its parts, unused entries as they were."""
    many, entries, length = books.entries.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((many, entries, length), np.int64)
        count = np.zeros((many, entries), np.int64)
        for batch in batches:
            x = list_matrix(batch.column(0), np.int64)
            code, _ = books.assign(x)
            for p in range(many):
                np.add.at(total[p], code[:, p], x[:, p * length : (p + 1) * length])
                count[p] += np.bincount(code[:, p], minlength=entries)
        part, entry, place = (i.ravel() for i in np.indices(total.shape))
        columns = [part, entry, place, np.repeat(count.ravel(), length), total.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["part", "entry", "place", "many", "total"])

    sums = rows.select("x").mapInArrow(add, "part long, entry long, place long, many long, total long")
    new = books.entries.copy()
    whole = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    for r in sums.groupBy("part", "entry", "place").agg(F.sum("many").alias("many"), whole).where("many > 0").collect():
        new[r["part"], r["entry"], r["place"]] = int(r["total"]) // r["many"]
    return Codebooks(new)


def _first_rows(rows: DataFrame, most: int) -> list[list[int]]:
    """The vectors of the `most` smallest ids."""
    known = rows.where(F.col("id").isNotNull())
    found = known.orderBy("id", "x").limit(most).collect()
    if len({r["id"] for r in found}) < len(found):  # ids repeat
        ids = [r["id"] for r in known.select("id").distinct().orderBy("id").limit(most).collect()]
        found = known.where(F.col("id").isin(ids)).groupBy("id").agg(F.min("x").alias("x")).orderBy("id").collect()
    return [r["x"] for r in found]


def compress(
    vectors: DataFrame,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """The key column, code (entry of each part), error, label_error and codebooks_sha256 of every vector that takes part."""
    rows = finite_vectors(vectors, key, vector, label).where((F.size("x") > 0) & (F.size("x") % parts == 0))
    start = rows.where(F.col("id").isNotNull()).orderBy("id", "x").select("x").first()
    kept = rows.where(F.size("x") == (len(start["x"]) if start else 0))
    dims = len(start["x"]) if start else parts
    size = padded(dims // parts)
    most = math.isqrt((1 << 61) // (size * dims))
    largest = kept.agg(F.max(F.array_max(F.transform("x", F.abs)))).first()[0] or 0.0
    if largest * scale >= most:
        raise ValueError(f"components of {largest} are too large: distances need whole numbers below {most}")
    kept = kept.select("id", "label", F.transform("x", lambda x: F.floor(x * float(scale))).alias("x"))
    kept = stored(kept, "codes-vectors")
    seeds = np.array(_first_rows(kept, entries), np.int64).reshape(-1, parts, dims // parts)
    books = Codebooks(seeds.transpose(1, 0, 2).copy())
    for _ in range(rounds if len(seeds) else 0):
        books = updated(books, kept)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, error = books.assign(list_matrix(batch.column(2), np.int64))
            text = [bytes(c).hex() for c in code.astype(np.uint8)]
            arrays = [batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(error)]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "label", "code", "error"])

    label_type = kept.schema["label"].dataType.simpleString()
    coded = stored(kept.mapInArrow(encode, f"id long, label {label_type}, code string, error long"), "codes")
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias(key), "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256")
    )
