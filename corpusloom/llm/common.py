"""What the operators of this package share."""

from __future__ import annotations

import ctypes
import functools
import functools
import gc
import sys
from collections.abc import Callable, Hashable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

T = TypeVar("T")

#: A word: a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows and bytes of an Arrow batch; a row that is larger makes a batch of its own.
BATCH_ROWS, BATCH_BYTES = 1000, 2 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python workers hold, so very long texts fit a small executor.

    Spark reads both settings when a plan runs, long after an operator has returned, so they stay; smaller ones are kept.
    """
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        have = spark.conf.get(name, None)
        try:
            set_ = have is not None and 0 < int(have) <= most
        except ValueError:  # a size with a unit
            set_ = False
        if not set_:
            spark.conf.set(name, str(most))


def tidy() -> None:
    """Give back to the system what a task has freed: workers are used again, and executors have one bound for all."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


Batches = Iterator[pa.RecordBatch]


def cached(name: str, key: Hashable, make: Callable[[], T]) -> T:
    """What a worker process keeps from task to task under a name, one value for each. Functions travel by value, so the
    process keeps it where every copy of this function finds it."""
    held = vars(sys).setdefault("_corpusloom_held", {})
    if held.get(name, (None,))[0] != key:
        held.pop(name, None)
        held[name] = key, make()
    return held[name][1]


def steady(run: Callable[[Batches], Batches] | None = None, keeps: tuple[str, ...] = ()):
    """A function for ``mapInArrow`` that leaves its worker's memory tidy: workers go from one operator's tasks to the
    next one's, so what is ``cached`` under other names than it ``keeps`` goes first."""
    if run is None:
        return functools.partial(steady, keeps=keeps)

    @functools.wraps(run)
    def wrapped(batches: Batches) -> Batches:
        held = vars(sys).setdefault("_corpusloom_held", {})
        if others := held.keys() - set(keeps):
            for name in others:
                del held[name]
            tidy()
        try:
            yield from run(batches)
        finally:
            tidy()

    return wrapped


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    """The number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_key(text: Column) -> Column:
    """128 bits that stand for a text, as a struct of two longs; null counts as the empty text."""
    t = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(t).alias("a"), F.xxhash64(F.lit(7), t, F.length(t)).alias("b"))


def nested(df: DataFrame) -> DataFrame:
    """The whole input row as one struct column ``row``, so that working columns clash with no input name."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"))


def numbered(df: DataFrame) -> DataFrame:
    """The same rows with columns named ``c0``, ``c1``, ..., so that working columns clash with no input name."""
    return df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)])
