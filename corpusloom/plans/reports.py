"""Reports over state, operations, documents and chunks; each is one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

STATUSES = ("pending", "processing", "synced", "error")

# Classes of errors and the texts that tell them, in order of precedence.
ERROR_CLASSES = [
    ("Corrupted Word Document", "not a Word file"),
    ("PDF Table Extraction Error", "not a textpage of this page"),
    ("PDF Memory Error", "weakly-referenced object no longer exists"),
    ("Document Parsing Error", "Failed to parse"),
]


def status_counts(state: DataFrame) -> DataFrame:
    return state.groupBy("sync_status").agg(F.count("*").alias("n"))


def progress(state: DataFrame, count_deleted: bool = False) -> DataFrame:
    """Counts by status, total and percent synced (0 if empty)."""
    counts = [F.count_if(F.col("sync_status") == s).alias(s) for s in STATUSES]
    total = F.count("*") if count_deleted else F.count_if(F.col("sync_status") != "deleted")
    one = state.agg(*counts, total.alias("total"))
    return one.withColumn("percent", F.coalesce(F.try_divide(F.col("synced") * 100.0, F.col("total")), F.lit(0.0)))


def status_share(state: DataFrame) -> DataFrame:
    """Counts and shares of the total; the window is over one row by status."""
    n = status_counts(state)
    return n.withColumn("percent", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()))


def error_prefix(message: Column) -> Column:
    """What stands before the first colon; ``Unknown`` without one."""
    return F.when(F.contains(message, F.lit(":")), F.substring_index(message, ":", 1)).otherwise("Unknown")


def error_groups(errors: DataFrame, message: str, key: str, examples: int = 3) -> DataFrame:
    """Errors by prefix: count, the first examples by key, and how many more there are.

    The examples are the least keys, found by rank within each prefix before anything is gathered.
    """
    named = errors.select(error_prefix(F.col(message)).alias("prefix"), F.col(key).alias("k"))
    ranked = named.withColumn("r", F.row_number().over(Window.partitionBy("prefix").orderBy("k")))
    return ranked.groupBy("prefix").agg(
        F.count("*").alias("n"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("r") <= examples, F.col("k")))), ",").alias("examples"),
        F.greatest(F.count("*") - examples, F.lit(0)).alias("more"),
    )


def error_class(message: Column) -> Column:
    """The first class whose text the message has."""
    known, out = F.coalesce(message, F.lit("Unknown error")), None
    for name, text in ERROR_CLASSES:
        hit = F.contains(known, F.lit(text))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("Other Error")


def error_categories(errors: DataFrame, message: str, suffix: Column) -> DataFrame:
    named = errors.select(error_class(F.col(message)).alias("category"), suffix.alias("suffix"))
    return named.groupBy("category").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set("suffix")), ",").alias("suffixes"))


def success_rate(failed: Column, total: Column) -> Column:
    return F.coalesce(F.try_divide((total - failed) * 100.0, total), F.lit(0.0))


def recent(rows: DataFrame, ts: str, key: str, n: int) -> DataFrame:
    """The latest rows, ties by key."""
    return rows.orderBy(F.desc(ts), F.desc(key)).limit(n)


def recent_with(rows: DataFrame, parents: DataFrame, on: str, ts: str, key: str, n: int) -> DataFrame:
    """The latest rows first, then what belongs to them; rows without a parent drop out."""
    return F.broadcast(recent(rows, ts, key, n)).join(parents, on)


def throughput(checkpoints: DataFrame, done: str, ts: str, by: Column, window: int = 5) -> DataFrame:
    """For each checkpoint the rate by minute since the checkpoint ``window - 1`` before it in its series."""
    w = Window.partitionBy(by).orderBy(ts)
    minutes = (F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.lag(ts, window - 1).over(w).cast("timestamp"))) / 60e6
    return checkpoints.withColumn("rate", F.coalesce(F.try_divide(F.col(done) - F.lag(done, window - 1).over(w), minutes), F.lit(0.0)))


def operations_summary(operations: DataFrame, kind: str, status: str, ms: str) -> DataFrame:
    """Mean time of successful additions, and counts."""
    ok = (F.col(kind) == "add") & (F.col(status) == "success")
    return operations.agg(F.avg(F.when(ok, F.col(ms))).alias("avg_ms"), F.count_if(ok).alias("added"), F.count_if(F.col(status) == "failed").alias("failed"))


def chunk_totals(documents: DataFrame, chunks: str = "total_chunks", tokens: str = "total_tokens") -> DataFrame:
    some = documents.where(F.col(chunks) > 0)
    return some.agg(
        F.coalesce(F.sum(chunks), F.lit(0)).alias("chunks"),
        F.coalesce(F.sum(tokens), F.lit(0)).alias("tokens"),
        F.coalesce(F.avg(chunks), F.lit(0.0)).alias("avg_chunks"),
        F.min(chunks).alias("min_chunks"),
        F.max(chunks).alias("max_chunks"),
        F.avg(tokens).alias("avg_tokens"),
    )


def batch_summary(parsed: DataFrame, success: str, words: str, pages: str) -> DataFrame:
    """Succeeded and failed, totals and means rounded down."""
    ok = F.count_if(F.col(success))
    total = lambda c: F.coalesce(F.sum(F.when(F.col(success), F.col(c))), F.lit(0))
    mean = lambda c: F.coalesce(F.floor(F.try_divide(total(c), ok)), F.lit(0)).cast("long")
    return parsed.agg(ok.alias("succeeded"), (F.count("*") - ok).alias("failed"), total(words).alias("words"), mean(words).alias("avg_words"), total(pages).alias("pages"), mean(pages).alias("avg_pages"))


def age(seconds: Column) -> Column:
    """Seconds, minutes or hours, rounded down, with their letter."""
    return (
        F.when(seconds < 60, F.concat(F.floor(seconds).cast("string"), F.lit("s")))
        .when(seconds < 3600, F.concat(F.floor(seconds / 60).cast("string"), F.lit("m")))
        .otherwise(F.concat(F.floor(seconds / 3600).cast("string"), F.lit("h")))
    )


def shorten(text: Column, most: int = 40) -> Column:
    return F.when(F.char_length(text) > most, F.concat(F.substring(text, 1, most - 3), F.lit("..."))).otherwise(text)


def eta(pending: Column, per_minute: Column, now: Column) -> Column:
    """(hours remaining, time of completion) at a rate; null where nothing is pending or nothing moves."""
    hours = F.when((pending > 0) & (per_minute > 0), pending / (per_minute * 60.0))
    return F.struct(hours.alias("hours_remaining"), F.timestamp_micros(F.unix_micros(now.cast("timestamp")) + (hours * 3600e6).cast("long")).alias("eta"))


def vector_estimate(vectors: Column, synced: Column, total: Column) -> Column:
    """Vectors to expect in the end: those of a synced file times all files; null before the first."""
    return F.when((vectors > 0) & (synced > 0), vectors / synced * total)


def recent_errors(state: DataFrame, n: int = 3) -> DataFrame:
    """The files that failed last."""
    return recent(state.where(F.col("sync_status") == "error"), "updated_at", "file_path", n)


def recent_processing(state: DataFrame, n: int = 5) -> DataFrame:
    """The files that were taken up last."""
    return recent(state.where(F.col("sync_status") == "processing"), "updated_at", "file_path", n)


def token_stats(chunks: DataFrame, tokens: str = "token_count") -> DataFrame:
    """Mean, least and most tokens of a chunk."""
    return chunks.agg(F.avg(tokens).alias("avg_tokens"), F.min(tokens).alias("min_tokens"), F.max(tokens).alias("max_tokens"))
