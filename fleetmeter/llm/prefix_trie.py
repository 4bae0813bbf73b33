"""The trie of conversation prefixes, built by halving depths.

A turn is a symbol (128 bits of the SHA-256 of role and text; texts leave their rows once). A problem is a root node at depth a and the sequences
below it, `width` turns deep. It is cut at half depth: the first halves are named, which gives the nodes at the cut; the
first halves are the upper problem, what follows a cut node is a lower problem with that node as its root. All problems
of one width are cut in one Spark round, so a trie D deep takes log2(D) rounds down. Half-depth pieces start at multiples
of their length, so their digests come from pairs of shorter ones. A name is the node's smallest member, found by
grouping on (depth, root's name, digest of the half): with its depth it identifies the node.

Sums over subtrees are grafted on the way back. When problems of width h become problems of 2h, the sum of each lower
problem goes to its root and to that node's ancestors in the upper problem, at most h rows for each cut node, and into the sum of the upper
problem. Nothing else moves between problems: log2(D) rounds up, and as many rows a round as half the nodes.

No conversation is ever gathered in a row: turns are numbered over sorted ranges, and every table has a row for each turn
at most. Members that end at a node are hashed in ascending order from pieces of bounded size.

Turns are ordered by turn (null first), equal turns by their symbol; repeated rows are turns of their own. A null role or
text counts as empty, rows with a null id belong to no conversation, and an empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetmeter.llm.common import stored

#: Bytes of joined ids that one row of a member list holds.
PIECE = 1 << 20


def _digest(value: Column) -> Column:
    return F.unhex(F.substring(F.sha2(value, 256), 1, 32))


def numbered(
    conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conv, pos (from 1), sym and words of every turn.

    Rows are sorted over ranges of (conversation, turn), so a conversation may span many tasks; its place in a range and
    the counts of the ranges before give the number.
    """
    said, by = F.coalesce(F.col(text).cast("string"), F.lit("")), F.coalesce(F.col(role).cast("string"), F.lit(""))
    symbol = _digest(F.concat(F.length(by).cast("string"), F.lit(":"), by, said))
    words = F.regexp_count(said, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    rows = conversations.select(
        F.col(key).cast("long").alias("conv"), F.col(turn).alias("turn"), symbol.alias("sym"), words.alias("words")
    ).where(F.col("conv").isNotNull())
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("sym")]
    rows = stored(rows, "trie-symbols").repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select("conv", "sym", "words", F.monotonically_increasing_id().alias("place"))
    rows = stored(rows, "trie-sorted").withColumn("range", F.shiftright("place", 33))
    ranges = rows.groupBy("conv", "range").agg(F.min("place").alias("first"), F.count("*").alias("many"))
    earlier = Window.partitionBy("conv").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("conv", "range", "first", F.coalesce(F.sum("many").over(earlier), F.lit(0)).alias("before"))
    pos = F.col("place") - F.col("first") + F.col("before") + 1
    return rows.join(ranges, ["conv", "range"]).select("conv", pos.alias("pos"), "sym", "words")


def rebuilt(turns: DataFrame, group: int = 20, most: int = 3) -> tuple[DataFrame, DataFrame]:
    """Conversations that open like the first of their `group` ids: the turns anew, and conv with its length.

    Conversation c takes its first crc32(c) % (most + 1) turns from conversation c - c % group, as far as there are any.
    """
    turns = stored(turns, "trie-turns")
    convs = turns.groupBy("conv").agg(F.max("pos").alias("many"))
    shared = F.crc32(F.col("conv").cast("string")) % (most + 1)
    convs = convs.select("conv", "many", shared.alias("shared"), (F.col("conv") - F.col("conv") % group).alias("opens"))
    bases = convs.select(F.col("conv").alias("opens"), F.col("many").alias("base_many"))
    taken = F.least("shared", F.coalesce("base_many", F.lit(0)))
    convs = convs.join(bases, "opens", "left").select("conv", "many", "opens", "shared", taken.alias("taken"))
    convs = stored(convs, "trie-plan")
    own = turns.join(convs.select("conv", "shared", "taken"), "conv").where(F.col("pos") > F.col("shared"))
    own = own.select("conv", (F.col("pos") - F.col("shared") + F.col("taken")).alias("pos"), "sym", "words")
    heads = turns.where(F.col("pos") <= most).withColumnRenamed("conv", "opens")
    first = convs.where("taken > 0").join(heads, "opens").where(F.col("pos") <= F.col("taken"))
    length = F.col("taken") + F.greatest(F.col("many") - F.col("shared"), F.lit(0))
    whole = own.unionByName(first.select("conv", "pos", "sym", "words"))
    return stored(whole, "trie-rebuilt"), stored(convs.select("conv", length.alias("length")), "trie-lengths")


def _named(turns: DataFrame, lengths: DataFrame, root: int, top: int) -> DataFrame:
    """conv, depth and name of the node that each conversation passes at each depth."""
    digests = {1: turns.select("conv", (F.col("pos") - 1).alias("i"), "sym")}
    h = 1
    while 2 * h < top:
        side = F.col("i") % 2
        halves = digests[h].groupBy("conv", F.expr("i div 2").alias("i")).agg(
            F.max(F.when(side == 0, F.col("sym"))).alias("left"), F.max(F.when(side == 1, F.col("sym"))).alias("right")
        )
        whole = halves.where(F.col("left").isNotNull() & F.col("right").isNotNull())
        digests[2 * h] = stored(whole.select("conv", "i", _digest(F.concat("left", "right")).alias("sym")), "trie-digests")
        h *= 2
    parts = [lengths.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(root).cast("long").alias("name"))]
    while h and top > 1:
        roots = reduce(DataFrame.unionByName, parts).withColumn("i", F.expr(f"depth div {h}"))
        rows = roots.join(digests[h], ["conv", "i"]).drop("i")
        cuts = rows.groupBy("depth", "name", "sym").agg(F.min("conv").alias("cut"))
        named = rows.join(cuts, ["depth", "name", "sym"])
        parts.append(stored(named.select("conv", (F.col("depth") + h).alias("depth"), F.col("cut").alias("name")), "trie-names"))
        h //= 2
    return reduce(DataFrame.unionByName, parts)


def _grafted(values: DataFrame, names: DataFrame, top: int, columns: list[str]) -> DataFrame:
    """depth, name and the `columns` summed over each node's subtree; `values` has depth, name, parent and columns."""
    sums = [F.sum(c).alias(c) for c in columns]
    known = names.where("depth > 0 AND name = conv").select("conv").distinct()
    paths = stored(names.join(known, "conv", "left_semi"), "trie-paths")
    added = [values.select("depth", "name", *columns)]
    problems = values.where("depth > 0").groupBy((F.col("depth") - 1).alias("a"), F.col("parent").alias("root")).agg(*sums)
    h = 1
    while h < top:
        problems = stored(problems, "trie-problems")
        cuts = problems.where(F.col("a") % (2 * h) == h).withColumnRenamed("root", "conv")
        above = paths.where("depth > 0").withColumn("block", F.expr(f"(depth - 1) div {h}"))
        graft = cuts.withColumn("block", F.expr(f"(a - 1) div {h}")).drop("a").join(above, ["conv", "block"])
        added.append(graft.select("depth", "name", *columns))
        roots = paths.where(F.col("depth") % (2 * h) == 0)
        upper = cuts.withColumn("depth", F.col("a") - h).drop("a").join(roots, ["conv", "depth"])
        upper = upper.select(F.col("depth").alias("a"), F.col("name").alias("root"), *columns)
        whole = problems.where(F.col("a") % (2 * h) == 0).select("a", "root", *columns)
        problems = whole.unionByName(upper).groupBy("a", "root").agg(*sums)
        h *= 2
    # All else in the trie is below the root, the one problem that is left.
    added.append(stored(problems, "trie-problems").select(F.col("a").alias("depth"), F.col("root").alias("name"), *columns))
    return reduce(DataFrame.unionByName, added).groupBy("depth", "name").agg(*sums)


def joined_digests(members: DataFrame) -> DataFrame:
    """depth, name and the SHA-256 of the ascending members, comma-joined. `members` has depth, name and conv."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, first, parts, size = None, None, [], 0

        def piece() -> pa.RecordBatch:
            row = [[at[0]], [at[1]], [first], [",".join(parts)]]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds, strict=True)], ["depth", "name", "first", "ids"])

        for batch in batches:
            out = []
            for depth, name, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != (depth, name) or size > PIECE:
                    if parts:
                        out.append(piece())
                    at, first, parts, size = (depth, name), conv, [], 0
                parts.append(str(conv))
                size += len(parts[-1]) + 1
            if out:
                yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
        if parts:
            yield piece()

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sha = None, None

        def row(done: list) -> pa.RecordBatch:
            columns = [[d[0][0] for d in done], [d[0][1] for d in done], [d[1] for d in done]]
            kinds = [pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["depth", "name", "ends_sha256"])

        for batch in batches:
            done = []
            for depth, name, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != (depth, name):
                    if at:
                        done.append((at, sha.hexdigest()))
                    at, sha = (depth, name), hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if done:
                yield row(done)
        if at:
            yield row([(at, sha.hexdigest())])

    order = ["depth", "name", "conv"]
    rows = members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.mapInArrow(pieces, "depth long, name long, first long, ids string")
    rows = rows.repartition("depth", "name").sortWithinPartitions("depth", "name", "first")
    return rows.mapInArrow(hashes, "depth long, name long, ends_sha256 string")


NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """A row for each node. `turns` has conv, pos (from 1, without gaps), sym and words; `lengths` has every conv."""
    least = lengths.agg(F.min("conv").alias("root"), F.max("length").alias("depth")).first()
    if least["root"] is None:
        return turns.sparkSession.createDataFrame([], NODES)
    top = 1 << int(least["depth"]).bit_length()  # above every depth
    names = _named(turns, lengths, least["root"], top)
    counts = names.groupBy("depth", "name").agg(F.count("*").alias("n_convs"))
    parents = names.select(F.col("conv").alias("name"), (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    last = turns.select(F.col("conv").alias("name"), F.col("pos").alias("depth"), "words")
    nodes = counts.join(parents, ["name", "depth"], "left").join(last, ["name", "depth"], "left")
    parent = F.when(F.col("depth") > 0, F.col("parent")).alias("parent")
    nodes = stored(nodes.select("depth", "name", parent, "n_convs", F.coalesce("words", F.lit(0)).alias("words")), "trie-nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("name"))
    children = children.agg(F.count("*").alias("n_children"))
    saved = ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")
    many = F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children")
    values = nodes.join(children, ["depth", "name"], "left").select("depth", "name", "parent", "n_convs", saved, many)
    values = stored(values.withColumn("n_leaves", (F.col("n_children") == 0).cast("long")), "trie-values")
    totals = _grafted(values, names, top, ["n_leaves", "saved_tokens"])
    ended = lengths.withColumnRenamed("length", "depth").join(names, ["conv", "depth"])
    table = values.drop("n_leaves", "saved_tokens").join(totals, ["depth", "name"])
    table = table.join(joined_digests(ended), ["depth", "name"], "left")
    return table.select(
        F.col("name").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
