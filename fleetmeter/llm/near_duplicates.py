"""Near-duplicate documents by BagMinHash signatures.

A document is the bag of its five-word shingles. Each shingle drives Poisson processes over its discretised weight: one
per shell of weights (0-1, 1-2, 2-4, 4-8, ...), at a rate of the shell's width. A point has a time, a register and a
level inside the shell, and counts where the level is below the document's weight. The earliest point of each register
makes up the signature, so two signatures agree in a register with the probability of their weighted Jaccard similarity.
A process stops once its time is beyond all registers, so a document costs little more than one point per shingle.

Texts with the same words are one node, however many there are. Nodes that share a band of registers meet, unless they
are in one class by then. First all are paired with the band's hub, the node with the largest bands overall; a copied
original is the hub of its copies. The pairs are verified on the whole bags, and links of a similarity of 0.8 or more
join nodes to classes. The nodes of bands that hold several classes then meet by their rarest shingles: each occurrence
of a shingle is a token, tokens have one order for all nodes, the rare ones first, and two bags of similarity 0.8 or more share one of the first
fifth of their tokens, plus one. So of these nodes, all pairs of different classes that can be similar are compared, and documents that
share a template, but not their rare shingles, never meet. The order comes from counts in a table of fixed size; which order it is changes
the work and not the links.

Two nodes of similarity 0.8 share any one band with probability 0.41, and 32 bands make it 1 - 5e-8 that they share one.
Nodes that share a band are in one class or have a similarity below 0.8.

Texts without words are copies of each other; texts of under five words have one shingle, all their words. A null text
is empty. A class is named by its smallest id (null if it has none but null). Rows that repeat are in one class. An
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetmeter.llm.common import Block, arrow_map, mix, slices, stored, text_bytes, texts_of, words_of

SHINGLE, SIMILAR = 5, 0.8
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
#: Size of the table of token counts, and the rows that it travels in.
LEVEL_BITS, LEVEL_PARTS = 22, 64
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def bags(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, weight) of all texts, sorted by text and shingle."""
    block = Block(texts)
    starts, _, words = words_of(block.data)
    owner = block.owner(starts)
    many = block.tally(owner)
    keys, docs = [], []
    if len(words) >= size:
        key = words[: len(words) - size + 1]
        for k in range(1, size):
            key = mix(key * _A + words[k : len(words) - size + 1 + k])
        whole = owner[: len(key)] == owner[size - 1 :]
        keys, docs = [key[whole]], [owner[: len(key)][whole]]
    begin = np.cumsum(many) - many
    for i in np.flatnonzero((many > 0) & (many < size)):
        key = many[i : i + 1].astype(np.uint64)
        for k in range(begin[i], begin[i] + many[i]):
            key = mix(key * _A + words[k : k + 1])
        keys.append(key)
        docs.append(np.array([i]))
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key, doc = np.concatenate(keys), np.concatenate(docs)
    order = np.lexsort((key, doc))
    key, doc = key[order], doc[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    return doc[first], key[first], np.diff(np.append(first, len(key)))


def signatures(many: int, doc: np.ndarray, key: np.ndarray, weight: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """A row of registers for each of `many` texts; zeros for a text without shingles."""
    docs, seeds, lows, rates, tops = [], [], [], [], []
    shell = 0
    while True:  # shell 0 holds weights 0 to 1, shell s those from 2 ** (s - 1) to 2 ** s
        low, width = (0, 1) if shell == 0 else (1 << (shell - 1), 1 << (shell - 1))
        pick = np.flatnonzero(weight > low)
        if not len(pick):
            break
        docs.append(doc[pick])
        seeds.append(mix(key[pick] + np.array([shell], np.uint64) * _B))
        lows.append(np.full(len(pick), low))
        rates.append(np.full(len(pick), float(width)))
        tops.append(weight[pick])
        shell += 1
    best = np.full(many * registers, np.inf)
    out = np.zeros(many * registers, np.uint32)
    if not docs:
        return out.reshape(many, registers)
    docs, seeds, lows, rates, tops = (np.concatenate(x) for x in (docs, seeds, lows, rates, tops))
    time, number = np.zeros(len(docs)), 0
    while len(docs):
        draw = mix(seeds + np.array([number], np.uint64) * _A)
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53) / rates
        other = mix(draw ^ _B)
        level = lows + ((other >> np.uint64(32)).astype(np.float64) * 2.0**-32 * rates).astype(np.int64)
        place = docs * registers + (other % np.uint64(registers)).astype(np.int64)
        pick = np.flatnonzero((level < tops) & (time < best[place]))
        np.minimum.at(best, place[pick], time[pick])
        won = pick[best[place[pick]] == time[pick]]
        out[place[won]] = (mix(draw[won] + _A) >> np.uint64(32)).astype(np.uint32)
        live = time < best.reshape(many, registers).max(1)[docs]
        docs, seeds, lows, rates, tops, time = (x[live] for x in (docs, seeds, lows, rates, tops, time))
        number += 1
    return out.reshape(many, registers)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags (sorted shingles, weights)."""
    _, x, y = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    common = int(np.minimum(a[1][x], b[1][y]).sum())
    return common / max(1, int(a[1].sum() + b[1].sum()) - common)


def _nodes(docs: DataFrame) -> DataFrame:
    """doc_id, node (a name of the text's words) and its bands; no bands for a text without words."""

    def make():
        def work(batch: pa.RecordBatch):
            keys, texts = batch.column(0), text_bytes(batch.column(1))
            for a, b in slices(np.array([len(t) for t in texts]), 1 << 20):
                some = texts[a:b]
                rows = signatures(b - a, *bags(some)).reshape(-1, ROWS).astype(np.uint64)
                name = np.tile(np.arange(BANDS, dtype=np.uint64), b - a)
                for k in range(ROWS):
                    name = mix(name * _A + rows[:, k])
                words = [t.split() for t in some]
                cuts = np.cumsum([0] + [BANDS * bool(w) for w in words])
                band = name[np.repeat([bool(w) for w in words], BANDS)].astype(np.int64)
                node = [hashlib.md5(b" ".join(w)).digest() for w in words]
                arrays = [keys.slice(a, b - a), pa.array(node, pa.binary())]
                arrays.append(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(band)))
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "node", "bands"])

        return work

    return arrow_map(texts_of(docs), "doc_id long, node binary, bands array<long>", make)


def _texts(docs: DataFrame) -> DataFrame:
    """node and the compressed text of every row."""

    def make():
        pack = zstandard.ZstdCompressor(level=1).compress

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            words = [b" ".join(t.split()) for t in text_bytes(batch.column(1))]
            arrays = [pa.array([f(w) for w in words], pa.binary()) for f in (lambda w: hashlib.md5(w).digest(), pack)]
            return pa.RecordBatch.from_arrays(arrays, ["node", "words"])

        return work

    return arrow_map(texts_of(docs), "node binary, words binary", make)


def band_members(bands: DataFrame) -> DataFrame:
    """band, node and weight (the size of all bands of the node) where nodes share a band, of rows (band, node)."""
    shared = bands.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    weight = F.sum("size").over(Window.partitionBy("node")).alias("weight")  # of a node's bands
    return stored(bands.join(shared, "band").select("band", "node", weight), "near-members")


def hub_pairs(members: DataFrame) -> DataFrame:
    """node and hub, distinct: each member of a band with the one that the most others can meet."""
    hubs = members.groupBy("band").agg(F.max(F.struct("weight", "node")).alias("hub")).select("band", F.col("hub.node").alias("hub"))
    return members.join(hubs, "band").where("node <> hub").select("node", "hub").distinct()


def tokens_of(text: bytes) -> np.ndarray:
    """A number for each occurrence of each shingle."""
    _, key, weight = bags([text])
    first = np.cumsum(weight) - weight
    again = np.arange(int(weight.sum())) - np.repeat(first, weight)
    return mix(np.repeat(key, weight) + again.astype(np.uint64) * _B)


def token_levels(texts: DataFrame) -> np.ndarray:
    """For each hash of a token, the logarithm of how many tokens of the texts have it. A table of fixed size."""

    def count(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        total = np.zeros(1 << LEVEL_BITS, np.int64)
        for batch in batches:
            held, size = [], 0
            for i, words in enumerate(batch.column(0).to_pylist(), 1):
                held.append(tokens_of(unpack(words)))
                size += len(held[-1])
                if size > 1 << LEVEL_BITS or i == len(batch):
                    place = (np.concatenate(held) >> np.uint64(64 - LEVEL_BITS)).astype(np.int64)
                    total += np.bincount(place, minlength=len(total))
                    held, size = [], 0
        if total.any():
            parts = [zstandard.ZstdCompressor(level=1).compress(p.tobytes()) for p in total.reshape(LEVEL_PARTS, -1)]
            salt = [int(total.sum()) % 64] * LEVEL_PARTS
            arrays = [pa.array(range(LEVEL_PARTS), pa.int32()), pa.array(salt, pa.int32()), pa.array(parts, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["part", "salt", "counts"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        unpack = zstandard.ZstdDecompressor().decompress
        total = sum(np.frombuffer(unpack(c), np.int64) for c in rows["counts"])
        packed = zstandard.ZstdCompressor(level=1).compress(total.tobytes())
        return pd.DataFrame({"part": rows["part"].iloc[:1], "salt": [0], "counts": [packed]})

    sums = texts.select("words").mapInArrow(count, "part int, salt int, counts binary")
    for by in (["part", "salt"], ["part"]):
        sums = sums.groupBy(*by).applyInPandas(add, "part int, salt int, counts binary")
    levels = np.zeros((LEVEL_PARTS, (1 << LEVEL_BITS) // LEVEL_PARTS), np.uint8)
    for r in sums.select("part", "counts").collect():
        counts = np.frombuffer(zstandard.ZstdDecompressor().decompress(r["counts"]), np.int64)
        levels[r["part"]] = np.ceil(np.log2(counts + 1))
    return levels.ravel()


def prefix(text: bytes, levels: np.ndarray, similar: float = SIMILAR) -> tuple[np.ndarray, int]:
    """The rarest tokens, of which a text as similar must have one in its own, and the number of all tokens."""
    tokens = tokens_of(text)
    take = len(tokens) - math.ceil(similar * len(tokens) - 1e-9) + 1
    order = np.lexsort((tokens, levels[(tokens >> np.uint64(64 - LEVEL_BITS)).astype(np.int64)]))
    return tokens[order[:take]], len(tokens)


def prefix_pairs(texts: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """node and hub of texts (node, words, root) of different roots that share one of their rarest tokens, where what
    follows it in the order of the tokens can still be common enough."""
    levels = token_levels(texts)

    def make():
        unpack = zstandard.ZstdDecompressor().decompress

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [prefix(unpack(words), levels, similar) for words in batch.column("words").to_pylist()]
            row = np.repeat(np.arange(len(found)), [len(t) for t, _ in found])
            token = np.concatenate([t for t, _ in found] or [np.zeros(0, np.uint64)]).view(np.int64)
            size = np.array([n for _, n in found], np.int64)[row]
            left = size - np.concatenate([np.arange(len(t)) for t, _ in found] or [np.zeros(0, np.int64)])
            arrays = [pa.array(token), batch.column("node").take(pa.array(row)), batch.column("root").take(pa.array(row))]
            return pa.RecordBatch.from_arrays([*arrays, pa.array(size), pa.array(left)], ["token", "node", "root", "size", "left"])

        return work

    rows = arrow_map(texts.select("node", "words", "root"), "token long, node binary, root binary, size long, left long", make)
    rows = stored(rows, "near-prefixes")
    shared = rows.groupBy("token").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("token")
    rows = stored(rows.join(shared, "token", "left_semi"), "near-rare")
    other = rows.select("token", *(F.col(c).alias(h) for c, h in (("node", "hub"), ("root", "hub_root"), ("size", "hub_size"), ("left", "hub_left"))))
    # all common tokens are at the first common one or after it, so that one passes for every similar pair
    enough = F.least("left", "hub_left") * (1 + similar) >= similar * (F.col("size") + F.col("hub_size")) - 1e-6
    pairs = rows.join(other, "token").where("node < hub AND root <> hub_root").where(enough)
    return pairs.select("node", "hub").distinct()


def verified(pairs: DataFrame, texts: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """The pairs whose bags are similar enough, of texts by node."""
    both = pairs.join(texts.withColumnRenamed("words", "own"), "node")
    both = both.join(texts.select(F.col("node").alias("hub"), F.col("words").alias("other")), "hub")

    def make():
        unpack = zstandard.ZstdDecompressor().decompress
        last: dict[bytes, tuple] = {}

        def bag(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
            return bags([unpack(packed)])[1:]

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            nodes, hubs = batch.column("node"), batch.column("hub")
            good = []
            for i in range(len(batch)):
                hub = hubs[i].as_py()
                if hub not in last:
                    last.clear()
                    last[hub] = bag(batch.column("other")[i].as_py())
                good.append(similarity(bag(batch.column("own")[i].as_py()), last[hub]) >= similar)
            return pa.RecordBatch.from_arrays([nodes, hubs], ["node", "hub"]).filter(pa.array(good, pa.bool_()))

        return work

    return arrow_map(both.select("node", "hub", "own", "other"), "node binary, hub binary", make)


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """node and root of every node that has a link: the least node it is connected to, by stars that grow and shrink."""
    edges = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "near-links")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "near-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select("v", "u", "m")
        small = small.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        edges = stored(small, "near-small")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state


def connected(bands: DataFrame, docs: DataFrame) -> DataFrame:
    """node and root of every node that has a link, of rows (band, node)."""
    members = band_members(bands)
    texts = _texts(docs).join(members.select("node").distinct(), "node", "left_semi")
    texts = stored(texts.groupBy("node").agg(F.first("words").alias("words")), "near-texts")
    pairs = stored(hub_pairs(members), "near-pairs")
    root = stored(components(verified(pairs, texts), "node", "hub"), "near-roots")
    members = members.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = members.groupBy("band").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("band")
    mixed = members.join(mixed, "band", "left_semi").select("node", "root").distinct()
    rare = prefix_pairs(stored(texts.join(mixed, "node"), "near-mixed"))
    links = stored(verified(rare, texts), "near-verified")
    return components(links.union(root.select("node", "root")), "node", "hub")


def classes(docs: DataFrame) -> DataFrame:
    """doc_id and class_id of every row."""
    nodes = stored(_nodes(docs), "near-nodes")
    bands = nodes.where(F.size("bands") > 0).groupBy("node").agg(F.first("bands").alias("bands"))
    root = connected(bands.select("node", F.explode("bands").alias("band")), docs)
    rooted = nodes.select("doc_id", "node").join(root, "node", "left")
    rooted = rooted.select("doc_id", F.coalesce("root", "node").alias("root"))
    named = rooted.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return rooted.join(named, "root").select("doc_id", "class_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of docs whose id names their class. Rows that repeat an id and a text stay together."""
    named = classes(docs).where(F.col("doc_id").eqNullSafe(F.col("class_id"))).select(F.col("doc_id").alias("kept")).distinct()
    row = docs.select(F.struct("*").alias("row"))
    return row.join(named, F.col("row.doc_id").cast("long").eqNullSafe(F.col("kept")), "left_semi").select("row.*")
