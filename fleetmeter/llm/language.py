"""Language identification in two steps: the family first, then the language within the family.

Both steps are votes of one-versus-one linear support vector machines over hashed byte trigrams of the lower-cased
text, in which everything but letters is a blank. A trigram adds its weight wherever it stands, so a text of any length
costs one pass over its bytes. The machines are fitted on a sample of labelled documents of every language (`SAMPLE`,
dealt evenly over the languages, those with the smallest hashed ids; beyond `LANGUAGES` it grows with their number).
Where there are more families than that, languages of no fixed family are put with those most alike. Every document is
predicted from its whole text.

A text that is null, or holds no letter, is `und` with score 0. An empty table, or one without labels, is predicted
`und`. Rows that repeat are predicted alike.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmeter.llm.common import PASS_BYTES, arrow_map, byte_table, slices

#: Documents that the machines are fitted on, at most, for up to `LANGUAGES` languages.
SAMPLE = 2000
#: Languages that share one sample, and families that are told apart one by one.
LANGUAGES = 64
BITS = 12
#: Families of languages by code; any other code is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk"),
    "uralic": ("fi", "et", "hu"),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

_LETTERS = byte_table(range(97, 123), range(128, 256))


def trigrams(data: np.ndarray) -> np.ndarray:
    """The bucket of the trigram that begins at each byte but the last two."""
    plain = np.where(_LETTERS[data], data, 32).astype(np.uint32)
    wide = (plain[:-2] << np.uint32(16)) | (plain[1:-1] << np.uint32(8)) | plain[2:]
    return (wide * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)


def _joined(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased texts, blanks around each, with starts and ends of their trigrams."""
    raw = [f"  {(t or '').lower()}  ".encode("utf-8", "replace") for t in texts]
    sizes = np.array([len(r) for r in raw], np.int64)
    starts = np.cumsum(sizes) - sizes
    return np.frombuffer(b"".join(raw), np.uint8), starts, starts + sizes - 2


def features(texts: list[str | None]) -> np.ndarray:
    """For each text, the share of every bucket among its trigrams, times the root of their number of buckets."""
    out = np.zeros((len(texts), 1 << BITS), np.float32)
    for i, text in enumerate(texts):
        data, _, ends = _joined([text])
        counts = np.bincount(trigrams(data)[: ends[0]], minlength=1 << BITS)
        out[i] = counts * (2 ** (BITS / 2) / max(1, counts.sum()))
    return out


def fit_machine(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, passes: int = 30) -> np.ndarray:
    """Weights, the last of them the bias, of a linear support vector machine; y is -1 or 1. Dual coordinate descent."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    weights, alpha = np.zeros(x.shape[1], np.float64), np.zeros(len(x))
    norms = (x.astype(np.float64) ** 2).sum(1)
    rng = np.random.default_rng(7)
    for _ in range(passes):
        moved = 0.0
        for i in rng.permutation(len(x)):
            new = min(max(alpha[i] - (y[i] * (x[i] @ weights) - 1) / norms[i], 0.0), penalty)
            if new != alpha[i]:
                weights += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-4:
            break
    return weights


@dataclass
class Machines:
    """One weight vector per pair of families, and per pair of languages of one family."""

    families: list[str]
    members: dict[str, list[str]]
    pairs: list[tuple[str, str]]
    weights: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if not self.families:
            return ["und"] * len(texts), [0.0] * len(texts)
        data, starts, ends = _joined(texts)
        places, scale = trigrams(data), 2 ** (BITS / 2)
        margin: dict[tuple[str, str], np.ndarray] = {}
        for pair, w in zip(self.pairs, self.weights, strict=True):
            total = np.zeros(len(places) + 1)
            np.cumsum(w[:-1].astype(np.float32)[places], dtype=np.float64, out=total[1:])
            margin[pair] = (total[ends] - total[starts]) * scale / (ends - starts) + w[-1]
        names, scores = [], []
        for i, text in enumerate(texts):
            if not text or not any(map(str.isalpha, text)):
                names.append("und")
                scores.append(0.0)
                continue
            family, sure = self._vote(self.families, margin, i)
            language, own = self._vote(self.members[family], margin, i)
            names.append(language)
            scores.append(float(1 / (1 + np.exp(-2 * min(sure, own, 30.0)))))
        return names, scores

    @staticmethod
    def _vote(names: list[str], margin: dict, i: int) -> tuple[str, float]:
        """The name that wins most of its duels, ties by its sum of margins, and its smallest won margin."""
        votes = {n: [0, 0.0] for n in names}
        for a, b in combinations(names, 2):
            m = margin[a, b][i]
            for n, own in ((a, m), (b, -m)):
                votes[n][0] += own > 0
                votes[n][1] += own
        best = max(names, key=lambda n: (*votes[n], n))
        won = [abs(margin[p][i]) for p in combinations(names, 2) if best in p]
        return best, min(won, default=30.0)


def _families(x: np.ndarray, lang: np.ndarray) -> dict[str, str]:
    """The family of each language of the rows."""
    out = {code: FAMILY_OF.get(code, code) for code in sorted(set(lang))}
    alone = [code for code in out if code not in FAMILY_OF]
    if len(set(out.values())) <= LANGUAGES:
        return out
    middle = np.array([x[lang == code].mean(0) for code in alone])
    middle /= np.linalg.norm(middle, axis=1, keepdims=True) + 1e-9
    left, size = list(range(len(alone))), int(np.ceil(np.sqrt(len(alone))))
    while left:
        near = sorted(left, key=lambda k: (k != left[0], -float(middle[k] @ middle[left[0]]), k))[:size]
        out.update((alone[k], f"like {alone[near[0]]}") for k in near)
        left = [k for k in left if k not in near]
    return out


def fit(labelled: DataFrame, sample: int = SAMPLE) -> Machines:
    """Machines from rows of doc_id, text and lang (not null)."""
    spot = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64(F.col("doc_id").cast("string")))
    keyed = labelled.select(spot.alias("spot"), "text", "lang")
    many = keyed.select("lang").distinct().count()
    if not many:
        return Machines([], {}, [], np.zeros((0, 1)))
    each = max(1, sample // min(many, LANGUAGES))
    spots = keyed.select("lang", "spot", F.pmod("spot", F.lit(16)).alias("salt"))
    for by in (["lang", "salt"], ["lang"]):  # a frequent language is thinned in shares first
        rank = F.row_number().over(Window.partitionBy(*by).orderBy("spot"))
        spots = spots.withColumn("rank", rank).where(F.col("rank") <= each)
    bounded = spots.select("lang", "spot").distinct()
    picked = keyed.join(F.broadcast(bounded), ["lang", "spot"]).groupBy("lang", "spot").agg(F.min("text").alias("text"))
    picked = picked.select("lang", "text")

    def make():
        def work(batch: pa.RecordBatch):
            texts = batch.column(1).to_pylist()
            for a, b in slices(np.array([len(t or "") for t in texts])):
                vectors = [v.tobytes() for v in features(texts[a:b])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(vectors)], ["lang", "x"])

        return work

    rows = arrow_map(picked, "lang string, x binary", make).collect()
    rows.sort(key=lambda r: (r["lang"], bytes(r["x"])))
    x = np.array([np.frombuffer(r["x"], np.float32) for r in rows]).reshape(len(rows), -1)
    lang = np.array([r["lang"] for r in rows])
    family_of = _families(x, lang)
    family = np.array([family_of[code] for code in lang])
    members = {f: sorted(set(lang[family == f])) for f in sorted(set(family))}
    pairs, weights = [], []
    for label, names in ((family, list(members)), *((lang, m) for m in members.values())):
        for a, b in combinations(names, 2):
            own = (label == a) | (label == b)
            pairs.append((a, b))
            weights.append(fit_machine(x[own], np.where(label[own] == a, 1.0, -1.0)))
    return Machines(list(members), members, pairs, np.array(weights).reshape(len(pairs), -1))


def predicted(docs: DataFrame, machines: Machines) -> DataFrame:
    """doc_id, lang_pred and score of every row."""

    def make():
        def work(batch: pa.RecordBatch):
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in slices(np.array([len(t or "") for t in texts]), PASS_BYTES):
                names, scores = machines.predict(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(a, b - a), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    ["doc_id", "lang_pred", "score"],
                )

        return work

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(rows, "doc_id long, lang_pred string, score double", make)


def held_out(folds: int, fold: int) -> Column:
    """Whether crc32(doc_id as text) leaves `fold`; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(folds)) == fold


def identify(docs: DataFrame) -> DataFrame:
    """Fit on the labelled documents outside the held-out fold (1 of 3), predict all."""
    train = docs.select("doc_id", "text", "lang").where(~held_out(3, 1) & F.col("lang").isNotNull())
    out = predicted(docs, fit(train))
    return out.select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score")
