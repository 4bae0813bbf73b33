"""Removal of line chunks that repeat across all documents, in DataFrame functions alone.

A line ends a chunk where a rolling hash over its hash and those of the two lines before it is divisible by `DIVISOR`,
so an inserted line moves no boundary beyond the next ones. Chunks of several lines are grouped by hash and bytes, with
partial aggregation before the shuffle; of equal chunks the first by (doc_id, place) stays, the others are removed.
Chunks of one line always stay.

A null text is empty and has no lines. A null id counts as the smallest. Of rows that repeat an id and a text none is
earlier than the other. A document may lose all lines; its text is then empty. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmeter.llm.common import stored

DIVISOR = 4


def _line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def _chunked(rows: DataFrame) -> DataFrame:
    """rows with _lines of the column _text, and their _chunks as (pos, size, chunk)."""
    rows = rows.withColumn("_lines", F.split("_text", "\n"))
    rows = rows.withColumn("_hash", F.transform("_lines", _line_hash))

    def ends(i: Column) -> Column:
        rolled = F.element_at("_hash", i)
        for back, factor in ((1, 31), (2, 961)):
            rolled = rolled + F.when(i > back, factor * F.get("_hash", i - back - 1)).otherwise(0)
        return (rolled % DIVISOR == 0) | (i == F.size("_lines"))

    rows = rows.withColumn("_ends", F.filter(F.sequence(F.lit(1), F.size("_lines")), ends)).drop("_hash")

    def chunk(end: Column, k: Column) -> Column:
        first = F.when(k > 0, F.get("_ends", k - 1)).otherwise(0) + 1
        text = F.array_join(F.slice("_lines", first, end - first + 1), "\n")
        return F.struct(k.alias("pos"), (end - first + 1).alias("size"), text.alias("chunk"))

    return rows.withColumn("_chunks", F.transform("_ends", chunk)).drop("_ends")


def _text() -> Column:
    return F.coalesce(F.col("_row.text").cast("string"), F.lit(""))


def _keyed(docs: DataFrame) -> DataFrame:
    """_row, _id and _th, a hash of the text."""
    rows = docs.select(F.struct("*").alias("_row"))
    rows = rows.select("_row", F.col("_row.doc_id").cast("long").alias("_id"), _text().alias("_text"))
    return rows.withColumn("_th", F.xxhash64("_text")).drop("_text")


def removals(docs: DataFrame) -> DataFrame:
    """_id, _th and the places of the chunks that go, for the documents that lose any."""
    rows = _chunked(_keyed(docs.select("doc_id", "text")).withColumn("_text", _text()))
    chunks = rows.select("_id", "_th", F.inline(F.filter("_chunks", lambda c: c["size"] > 1))).drop("size")
    chunks = chunks.withColumn("key", F.xxhash64("chunk"))
    here = F.struct(F.col("_id"), F.col("pos"))
    groups = chunks.groupBy("key", "chunk").agg(F.min(here).alias("first"), F.count("*").alias("many"))
    firsts = groups.groupBy("key").agg(
        F.count("*").alias("texts"), F.min("first").alias("first"), F.sum("many").alias("many")
    )
    firsts = stored(firsts.where("many > 1"), "line-firsts")
    # all chunks of a key were compared byte by byte: one text means that they are equal
    gone = chunks.select("_id", "_th", "pos", "key").join(firsts.where("texts = 1").select("key", "first"), "key")
    gone = gone.where(here > F.col("first")).select("_id", "_th", "pos")
    mixed = firsts.where("texts > 1")
    if mixed.take(1):
        apart = groups.join(mixed.select("key"), "key", "left_semi").select("key", "chunk", "first")
        more = chunks.join(apart, ["key", "chunk"]).where(here > F.col("first"))
        gone = gone.union(more.select("_id", "_th", "pos"))
    return gone.groupBy("_id", "_th").agg(F.collect_set("pos").alias("_gone"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The rows of docs (as the struct _row), _n_lines, _n_chunks, _n_removed (lines) and the text that stays, _kept."""
    gone = stored(removals(docs), "line-removals")
    lost = gone.withColumnRenamed("_id", "_lost_id").withColumnRenamed("_th", "_lost_th")
    same = F.col("_id").eqNullSafe(F.col("_lost_id")) & (F.col("_th") == F.col("_lost_th"))
    lost = lost.hint("shuffle_hash")  # one form at every size: texts move once, in _row, and are not sorted
    again = _chunked(_keyed(docs).join(lost, same, "left").withColumn("_text", _text()))
    kept = F.filter("_chunks", lambda c: F.isnull("_gone") | ~F.array_contains(F.coalesce("_gone", F.array()), c["pos"]))
    again = again.withColumn("_stay", kept)
    pieces = F.transform("_stay", lambda c: c["chunk"])
    lines = F.aggregate("_stay", F.lit(0).cast("long"), lambda n, c: n + c["size"])
    return again.select(
        "_row",
        F.when(F.col("_text") == "", 0).otherwise(F.size("_lines")).cast("long").alias("_n_lines"),
        F.when(F.col("_text") == "", 0).otherwise(F.size("_chunks")).cast("long").alias("_n_chunks"),
        (F.size("_lines") - lines).alias("_n_removed"),
        F.array_join(pieces, "\n").alias("_kept"),
    )


def summary(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_chunks, n_removed and the SHA-256 of the text that stays."""
    counts = [F.col(f"_{c}").alias(c) for c in ("n_lines", "n_chunks", "n_removed")]
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select(F.col("_row.doc_id").cast("long").alias("doc_id"), *counts, F.sha2("_kept", 256).alias("kept_sha256"))


def replace_texts(docs: DataFrame) -> DataFrame:
    """The rows of docs with the text that stays; a text without removals is as it was."""
    text = F.when(F.col("_n_removed") > 0, F.col("_kept")).otherwise(F.col("_row.text")).alias("text")
    return dedup_lines(docs).select(*(text if c == "text" else F.col("_row").getField(c).alias(c) for c in docs.columns))
