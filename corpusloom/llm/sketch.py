"""Document fingerprints: a sketch of every shingle hash below a fixed threshold, with DataFrame functions alone.

Whether a hash is kept depends on it alone, so sketches of parts merge by union into the sketch of the whole, and
containment can be estimated between documents of very unequal lengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.common import let, words
from corpusloom.session import Scratch, release

#: Words of a shingle, and the share of all hashes that a sketch retains.
SHINGLE, FRACTION = 5, 0.25


def sketch(text: Column, shingle: int = SHINGLE, fraction: float = FRACTION) -> Column:
    """The sorted distinct shingle hashes of a text that lie in the lowest ``fraction`` of all 64-bit hashes.

    A text of fewer words than a shingle has one shingle of all its words; a null or blank text has none.
    """
    limit = F.lit(-(1 << 63) + int(fraction * (1 << 64)) if fraction < 1 else (1 << 63) - 1).cast("long")

    def hashed(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.greatest(F.size(w) - shingle, F.lit(0)))
        hashes = F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(shingle)]))
        low = F.sort_array(F.array_distinct(F.filter(hashes, lambda h: h <= limit)))
        return F.when(F.size(w) > 0, low).otherwise(F.array().cast("array<bigint>"))

    return let(words(text), hashed)


def merge(a: Column, b: Column) -> Column:
    """The sketch of two parts together."""
    return F.sort_array(F.array_union(a, b))


def likeness(a: Column, b: Column, equal: Column | None = None) -> Column:
    """Estimated Jaccard similarity of what two sketches stand for. Two empty sketches tell nothing: 1 if the texts
    are known to be ``equal``, else 0."""
    both, all_ = F.size(F.array_intersect(a, b)), F.size(a) + F.size(b)
    unknown = F.when(equal, 1.0).otherwise(0.0) if equal is not None else F.lit(0.0)
    return F.when(all_ == 0, unknown).otherwise(both / (all_ - both).cast("double"))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the first that the second contains; 1 if the first is empty."""
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a).cast("double"))


def encoded(a: Column) -> Column:
    """A sketch as a string: 16 hex digits for each hash, in order."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def fingerprints(documents: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: its key and its sketch as ``sketch``. Any text gives a sketch, null and blank ones an empty
    one; so may a text of few words, as the threshold is the same for all. A very long text keeps a fixed share of its
    shingles. Repeated rows, null keys and further columns of any name are allowed; an empty table gives no row."""
    return documents.select(F.col(f"`{key}`").alias("doc_id"), sketch(F.col(f"`{text}`")).alias("sketch"))


def with_next(documents: DataFrame, text: str = "text", key: str = "doc_id", ranges: int | None = None) -> DataFrame:
    """``doc_id``, ``text`` and the text of the next document in descending key order as ``next_text``.

    The first follows the last. Null texts count as empty, very long ones stay whole; null keys come last; rows of equal
    key are ordered by a hash of their text, and equal rows follow each other. Further columns of any name are left out.
    An empty table gives an empty result.

    Rows are dealt once, to ranges of keys of about equal numbers of rows as Spark samples them (``ranges``, four for
    each shuffle partition), and lie in buckets by range from then on. The first row of each range is what follows the
    last of the range before: as many rows as there are ranges, which a join brings there.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark)
    base = documents.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc_nulls_last("doc_id"), F.desc("tie")]
    dealt = base.withColumn("tie", F.xxhash64("text")).repartitionByRange(ranges or 4 * buckets, *order).withColumn("part", F.spark_partition_id())
    dealt = scratch.bucketed(dealt, "ranges", "part", dealt=True)
    release(spark)
    # one row for each range, which is what a window without partitions gets
    head = F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id").alias("id"), F.col("tie").alias("t"))
    heads = scratch.table(dealt.groupBy("part").agg(F.max(head).alias("head")), "heads")
    w = Window.orderBy("part")
    first = dealt.join(heads, "part").where(F.col("doc_id").eqNullSafe(F.col("head.id")) & (F.col("tie") == F.col("head.t"))).groupBy("part").agg(F.first("text").alias("head_text"))
    before = heads.select("part", F.coalesce(F.lag("part").over(w), F.max("part").over(Window.partitionBy())).alias("before"))
    guests = scratch.table(before.join(first, "part").select(F.col("before").alias("part"), "head_text"), "guests")
    scratch.drop(heads)
    followed = dealt.withColumn("next_text", F.lead("text").over(Window.partitionBy("part").orderBy(*order)))
    return followed.join(guests, "part").select("doc_id", "text", F.coalesce("next_text", "head_text").alias("next_text"))


def edited(text: Column, following: Column) -> Column:
    """A text whose last half (rounded down) is replaced by as many first code points of another, or all of it."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))
