"""Quality rules as a short-circuit cascade.

Every rule rejects a document by itself, so a verdict doesn't depend on the order. The order only saves work: each
rule's cost (seconds a byte) and the share of bytes it rejects are measured on a bounded sample, and the rules run by
rejection per cost; a document that one rule rejects isn't shown to the next.

Null and empty texts have no words and are rejected as too short. An empty table gives no rows. Rows that repeat are
judged alike. Other columns pass through `filter_documents` unchanged, whatever their names.
"""

from __future__ import annotations

import time
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmeter.llm.common import SPACE, Block, arrow_map, byte_table, mix, runs_of, slices, text_bytes, texts_of, words_of

#: Documents that costs and selectivities are measured on.
SAMPLE = 512

SYMBOLS = byte_table(*b"#*$%&|<>")
_UPPER, _LOWER = byte_table(range(65, 91)), byte_table(range(97, 123))
_POINTS = ~SPACE & byte_table(range(0, 128), range(192, 256))
_LINE = byte_table(10)
_SHOUTS = byte_table(*b"!?")


class Measured(Block):
    """Counts of each text of a block, computed when first asked for."""

    def __init__(self, texts: list[bytes]):
        super().__init__(texts)
        self.have: dict[str, np.ndarray] = {}

    def __getattr__(self, name: str) -> np.ndarray:
        if name.startswith("_") or not hasattr(Measured, f"_{name}"):
            raise AttributeError(name)
        if name not in self.have:
            self.have[name] = getattr(self, f"_{name}")()
        return self.have[name]

    def _words(self):
        starts, _, hashes = words_of(self.data)
        return self.owner(starts), hashes

    def _n_words(self):
        return self.tally(self.words[0])

    def _word_chars(self):
        return self.count(_POINTS)

    def _n_symbols(self):
        return self.count(SYMBOLS)

    def _n_shouts(self):
        return self.count(_SHOUTS)

    def _n_upper(self):
        return self.count(_UPPER)

    def _n_lower(self):
        return self.count(_LOWER)

    def _lines(self):
        """Owners and hashes of the lines that hold a word."""
        starts, ends, hashes = runs_of(self.data, _LINE)
        seen = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(~SPACE[self.data], out=seen[1:])
        worded = seen[ends] > seen[starts]
        return self.owner(starts[worded]), hashes[worded]

    def _n_lines(self):
        return self.tally(self.lines[0])

    def _n_dup_lines(self):
        owners, hashes = self.lines
        _, first = np.unique(mix(hashes + owners.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
        return self.n_lines - self.tally(owners[first])

    def _n_repeat_words(self):
        owners, hashes = self.words
        if len(hashes) < 3:
            return np.zeros(self.many, np.int64)
        keys = hashes * np.uint64(0x9E3779B97F4A7C15)
        keys = mix(keys[:-2] + mix(keys[1:-1] + hashes[2:])) + owners[2:].astype(np.uint64)
        keys = mix(keys * np.uint64(0xD6E8FEB86659FD93))
        whole = np.flatnonzero(owners[:-2] == owners[2:])
        _, back, many = np.unique(keys[whole], return_inverse=True, return_counts=True)
        again = whole[many[back] > 1]
        covered = np.zeros(len(hashes), bool)
        for k in range(3):
            covered[again + k] = True
        return self.tally(owners[covered])


#: Base rules and the rest; each gives a boolean for every text of a block.
BASE: dict[str, Callable[[Measured], np.ndarray]] = {
    "few_words": lambda m: m.n_words < 50,
    "repeated_windows": lambda m: 100 * m.n_repeat_words > 50 * m.n_words,
}
RULES: dict[str, Callable[[Measured], np.ndarray]] = {
    **BASE,
    "symbols": lambda m: 10 * m.n_symbols > m.n_words,
    "repeated_lines": lambda m: 10 * m.n_dup_lines > 5 * m.n_lines,
    "capitals": lambda m: 2 * m.n_upper > m.n_upper + m.n_lower,
    "shouts": lambda m: 4 * m.n_shouts > m.n_words,
    "word_length": lambda m: (m.word_chars < 2 * m.n_words) | (m.word_chars > 20 * m.n_words),
}


def verdicts(texts: list[bytes], order: list[str]) -> list[str | None]:
    """For each text, the first rule of the order that rejects it."""
    found: list[str | None] = [None] * len(texts)
    left = np.arange(len(texts))
    block = Measured(texts)
    for name in order:
        if not len(left):
            break
        bad = RULES[name](block)
        if bad.any():
            for i in left[bad]:
                found[i] = name
            left = left[~bad]
            block = Measured([texts[i] for i in left])
    return found


def measured_order(docs: DataFrame, sample: int = SAMPLE) -> list[str]:
    """The rules by rejection per cost, measured on the `sample` documents with the smallest hashed ids."""
    spark = docs.sparkSession
    keyed = texts_of(docs).withColumn("spot", F.xxhash64(F.col("doc_id")))
    spots = [r["spot"] for r in keyed.select("spot").orderBy("spot").limit(sample).collect()]
    picked = keyed.where(F.col("spot") <= max(spots, default=0)).select("text").limit(2 * sample)

    def make():
        def work(batch: pa.RecordBatch):
            rows = []
            texts = text_bytes(batch.column(0))
            for a, b in slices(np.array([len(t) for t in texts])):
                for name, rule in RULES.items():
                    block = Measured(texts[a:b])
                    began = time.perf_counter()
                    bad = rule(block)
                    size = block.ends - block.starts + 1
                    rows.append((name, time.perf_counter() - began, float(size[bad].sum()), float(size.sum())))
            names = ["rule", "cost", "rejected", "size"]
            kinds = [pa.string(), pa.float64(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names
            )

        return work

    found = arrow_map(picked, "rule string, cost double, rejected double, size double", make)
    sums = found.groupBy("rule").agg(*(F.sum(c).alias(c) for c in ("cost", "rejected", "size"))).collect()
    worth = {r["rule"]: r["rejected"] / max(r["cost"], 1e-9) for r in sums}
    return sorted(RULES, key=lambda n: (-worth.get(n, 0.0), n))


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, and the rule that rejected the document."""
    order = measured_order(docs)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def make():
        def work(batch: pa.RecordBatch):
            keys, texts = batch.column(0), text_bytes(batch.column(1))
            for a, b in slices(np.array([len(t) for t in texts])):
                block = Measured(texts[a:b])
                failed = np.logical_or.reduce([rule(block) for rule in BASE.values()])
                pick = np.flatnonzero(~failed)
                rejected: list[str | None] = ["base"] * (b - a)
                rest = verdicts([texts[a + i] for i in pick], [n for n in order if n not in BASE])
                for i, name in zip(pick, rest, strict=True):
                    rejected[i] = name
                kept = pa.array([r is None for r in rejected])
                arrays = [keys.slice(a, b - a), *(pa.array(getattr(block, c)) for c in counts), pa.array(failed), kept]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.array(rejected, pa.string())], ["doc_id", *counts, "base_failed", "kept", "rejected_by"]
                )

        return work

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in counts) + ", base_failed boolean, kept boolean, rejected_by string"
    return arrow_map(texts_of(docs), schema, make)


def filter_documents(docs: DataFrame) -> DataFrame:
    """The rows of docs that no rule rejects."""
    order = measured_order(docs)
    place = docs.columns.index("text")

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = text_bytes(batch.column(place).cast(pa.string()))
            found: list[str | None] = []
            for a, b in slices(np.array([len(t) for t in texts])):
                found += verdicts(texts[a:b], order)
            return batch.filter(pa.array([f is None for f in found], pa.bool_()))

        return work

    return arrow_map(docs, docs.schema, make)
