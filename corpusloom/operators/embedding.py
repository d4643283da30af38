"""Embedders: an interface, a deterministic hashing embedder, token and cost estimates, registries."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions.cleaning import split_words
from corpusloom.session import written


class Embedder(Protocol):
    """Turns texts into vectors; runs on the workers in Arrow batches."""

    name: str
    dimension: int

    def embed(self, texts: list[str]) -> np.ndarray: ...


@dataclass(frozen=True)
class HashingEmbedder:
    """Counts of words by hash, with signs, scaled to length 1. The same text gives the same vector everywhere."""

    dimension: int = 64
    name: str = "hashing"

    def embed(self, texts: list[str]) -> np.ndarray:
        split = [(t or "").lower().split() for t in texts]
        number: dict[str, int] = {}
        word = np.array([number.setdefault(w, len(number)) for words in split for w in words], dtype=np.int64)
        row = np.repeat(np.arange(len(texts)), [len(words) for words in split])
        # each word is hashed once, and each word of a text counted at once
        h = np.array([zlib.crc32(w.encode("utf-8", "replace")) for w in number], dtype=np.int64)
        pairs, counts = np.unique(row * max(1, len(number)) + word, return_counts=True)
        row, word = np.divmod(pairs, max(1, len(number)))
        out = np.zeros((len(texts), self.dimension))
        np.add.at(out, (row, h[word] % self.dimension), np.where(h[word] & 0x80000000, 1.0, -1.0) * counts)
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, norms, out=np.zeros_like(out), where=norms > 0)


# Dimension, batch size, price in dollars for 1000 tokens.
PROVIDERS = {
    "sentence_transformers": (768, 32, 0.0),
    "openai_small": (1536, 2048, 0.00002),
    "openai_large": (3072, 2048, 0.00013),
    "cohere": (1024, 96, 0.0001),
}


def registry(spark: SparkSession) -> DataFrame:
    rows = [(k, *v) for k, v in PROVIDERS.items()]
    return spark.createDataFrame(rows, "provider string, dimension int, batch_size int, cost_per_1k double")


def embed(documents: DataFrame, text: str, embedder: Embedder, column: str = "embedding") -> DataFrame:
    """The input with its text's vector beside it; the vector travels in the row, so nothing is matched by position."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema.fields)
    at = documents.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = embedder.embed(b.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(v.astype(np.float32).tolist(), pa.list_(pa.float32()))], names=[*b.schema.names, column])

    return documents.mapInArrow(run, f"{fields}, `{column}` array<float>")


def estimated_tokens(text: Column) -> Column:
    """Three quarters of the words, rounded down."""
    return F.floor(F.size(split_words(text)) * 0.75).cast("long")


def batches(documents: DataFrame, key: str, text: str, size: int, price: float) -> DataFrame:
    """Totals of embedding in batches of ``size``, in the order of keys: rows, tokens, cost, batches, and the share of
    batches that succeed. A batch succeeds if all its texts have words.

    Numbers by key come from counts of ranges, so no task numbers all rows: see ``numbered``.
    """
    ok = F.size(split_words(F.col(text))) > 0
    rows = numbered(documents.select(F.col(key).alias("k"), estimated_tokens(F.col(text)).alias("t"), ok.alias("ok")), "k")
    per = rows.groupBy(F.floor(F.col("n") / size).alias("batch")).agg(F.count("*").alias("c"), F.sum("t").alias("t"), F.min(F.col("ok").cast("int")).alias("ok"))
    return per.agg(
        F.sum("c").alias("embeddings"),
        F.sum("t").alias("tokens"),
        (F.sum("t") / 1000.0 * price).alias("cost"),
        F.count("*").alias("batches"),
        (F.sum("ok") / F.count("*")).alias("success_rate"),
    )


def numbered(rows: DataFrame, key: str) -> DataFrame:
    """Rows with ``n``, their number from 0 in the order of ``key``, which is unique: rows are counted by ranges of keys,
    the counts are summed before each range, and ranks are taken inside."""
    ranged = written(rows.repartitionByRange(key).withColumn("__part", F.spark_partition_id()), "numbered")
    counts = ranged.groupBy("__part").agg(F.count("*").alias("__c"))
    before = counts.select("__part", (F.sum("__c").over(Window.orderBy("__part")) - F.col("__c")).alias("__before"))  # a row for each range
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(key))
    return ranged.withColumn("__inside", inside).join(before, "__part").withColumn("n", F.col("__before") + F.col("__inside") - 1).drop("__part", "__inside", "__before")


def info(spark: SparkSession, embedders: list[Embedder] = ()) -> DataFrame:
    """The known providers and the embedders at hand: which are ready."""
    ready = [(e.name, e.dimension, True) for e in embedders]
    known = [(k, v[0], False) for k, v in PROVIDERS.items() if k not in {r[0] for r in ready}]
    return spark.createDataFrame(ready + known, "provider string, dimension int, ready boolean")


def compare(documents: DataFrame, text: str, embedders: dict[str, tuple[Embedder, int, float]]) -> DataFrame:
    """The same texts by several embedders (each with batch size and price): ``provider``, ``dimension`` and the totals
    of ``batches``, a row for each, with the share of texts that got a vector of some length."""
    out = None
    for name, (embedder, size, price) in embedders.items():
        vectors = embed(documents, text, embedder, "__vector")
        some = F.exists("__vector", lambda x: x != 0)
        row = vectors.agg(
            F.count("*").alias("embeddings"), F.sum(estimated_tokens(F.col(text))).alias("tokens"), (F.sum(estimated_tokens(F.col(text))) / 1000.0 * price).alias("cost"),
            F.ceil(F.count("*") / size).cast("long").alias("batches"), (F.count_if(some) / F.count("*")).alias("success_rate"),
        ).select(F.lit(name).alias("provider"), F.lit(embedder.dimension).alias("dimension"), "*")
        out = row if out is None else out.union(row)
    return out
