"""Line dedup: drop the lines whose normalised form occurs in many documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import let, nested
from corpusloom.session import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Frequent lines up to which their set is broadcast (24 bytes each); more are joined by a shuffle.
BROADCAST_LINES = 500_000


def line_key(line: Column) -> Column:
    """A line without white space at its ends and with A-Z in lower case."""
    return F.translate(F.regexp_replace(line, r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z", ""), UPPER, LOWER)


def _hash(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("a"), F.xxhash64(F.lit(11), key).alias("b"))


def drop_frequent_lines(documents: DataFrame, text: str = "text", threshold: int = 10, min_length: int = 1) -> DataFrame:
    """Each input row, as struct ``row``, with ``kept`` text, ``n_lines`` and ``n_dropped``.

    A line's key is hashed to 128 bits; keys of at least ``min_length`` code points found in at least ``threshold``
    documents lose all their lines. Every input row is a document, repeated rows included. A null or empty text is
    one empty line and is kept as an empty text. An empty table gives an empty result.

    Null and repeated keys and further columns of any name are allowed; a very long text is one row of hashes.

    What is dropped from a text depends on the text alone, so positions come back by the hash of the text, and copies
    are counted once. Lines without a key take part in no join. The frequent keys are counted before they are broadcast;
    more of them are joined, and a table stands before each join, so that Spark can split a line or a text that a third
    of all rows share.
    """
    scratch = Scratch(documents.sparkSession)
    base = nested(documents).withColumn("text", F.coalesce(F.col("row")[text], F.lit("")))
    base = base.withColumn("lines", F.split("text", "\n", -1))
    hashes = base.select(F.xxhash64("text").alias("ta"), F.xxhash64(F.lit(5), "text").alias("tb"), F.transform("lines", lambda x: line_key(x)).alias("keys"))
    hashes = hashes.select("ta", "tb", F.transform("keys", lambda k: F.when(F.char_length(k) >= max(1, min_length), _hash(k))).alias("hashes"))
    keyed = scratch.table(hashes.groupBy("ta", "tb").agg(F.count("*").alias("copies"), F.first("hashes").alias("hashes")), "lines")
    each = keyed.select("copies", F.explode(F.array_distinct("hashes")).alias("hash")).where("hash is not null")
    frequent = scratch.table(each.groupBy("hash").agg(F.sum("copies").alias("df")).where(F.col("df") >= threshold).select("hash"), "frequent-lines")
    placed = keyed.select("ta", "tb", F.posexplode("hashes").alias("pos", "hash")).where("hash is not null")
    hits = placed.join(F.broadcast(frequent) if frequent.count() <= BROADCAST_LINES else frequent, "hash")
    lists = scratch.table(hits.groupBy("ta", "tb").agg(F.collect_list("pos").alias("gone")), "gone")
    scratch.drop(keyed, frequent)
    b = base.select("row", F.xxhash64("text").alias("ta"), F.xxhash64(F.lit(5), "text").alias("tb"))
    joined = b.join(lists, ["ta", "tb"], "left").withColumn("lines", F.split(F.coalesce(F.col("row")[text], F.lit("")), "\n", -1))
    spot = lambda p, left: F.struct(p.alias("pos"), F.lit(left).alias("left"))
    spots = F.array_sort(F.concat(F.transform("gone", lambda p: spot(p, False)), F.transform(F.sequence(F.lit(0), F.size("lines") - 1), lambda p: spot(p, True))))

    def stay(spots: Column) -> Column:
        """Positions that no dropped line stands before in the order of positions, dropped ones first."""
        own = F.filter(spots, lambda s, i: s["left"] & ((i == 0) | F.get(spots, i - 1)["left"] | (F.get(spots, i - 1)["pos"] != s["pos"])))
        return F.array_join(F.transform(own, lambda s: F.get(F.col("lines"), s["pos"])), "\n")

    kept = F.when(F.col("gone").isNull(), F.col("row")[text]).otherwise(let(spots, stay))
    dropped = F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long")
    return joined.select("row", F.coalesce(kept, F.lit("")).alias("kept"), F.size("lines").cast("long").alias("n_lines"), dropped.alias("n_dropped"))
