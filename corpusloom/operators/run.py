"""Runs over pending files: cleaned, cut, and their state written on; until nothing is pending."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import config
from corpusloom.functions import cleaning as C
from corpusloom.operators import chunking as K
from corpusloom.operators import state as S
from corpusloom.operators import vectors as W
from corpusloom.operators.embedding import Embedder, embed
from corpusloom.session import written


@dataclass(frozen=True)
class Run:
    """What a run leaves: the new state, and what it has added of documents, chunks, payloads with vectors, operations."""

    state: DataFrame
    documents: DataFrame
    chunks: DataFrame
    vectors: DataFrame
    operations: DataFrame


def process_pending(state: DataFrame, files: DataFrame, context: Callable[[Column], Column], embedder: Embedder, limit: int | None = None, how: K.Cuts = K.Cuts(), key: str = "file_path") -> Run:
    """Process the pending files, or the first ``limit`` by path.

    ``files`` has ``key``, ``text`` and ``error`` (of parsing, null if it went well), and may have ``file_size_bytes``. A
    file with an error, or that is not there, is in error afterwards with one failure more; any other is synced, without
    failures. An empty text is no error: it gets the described form's chunk. Files that are not pending stay as they are.
    """
    todo = written(S.pending(state, limit, key).select(key), "pending")
    size = F.col("file_size_bytes") if "file_size_bytes" in files.columns else F.lit(0)
    rows = todo.join(files.select(key, "text", "error", size.alias("file_size_bytes")), key, "left").join(files.select(key).withColumn("__here", F.lit(True)), key, "left")
    rows = rows.withColumn("error", F.when(F.col("__here").isNull(), "File not found").otherwise(F.col("error"))).drop("__here")
    cleaned = C.clean(F.col("text"))
    documents = written(rows.withColumn("cleaned", F.when(F.col("error").isNull(), cleaned)), "documents")
    good = documents.where("error IS NULL").withColumn("doc_id", F.col(key))
    chunks = written(K.chunk_documents(good, context(F.col(key)), "doc_id", "cleaned", path=F.col(key), size=F.col("file_size_bytes"), how=how), "chunks")
    vectors = embed(W.chunk_payload(chunks, embedder.name), "text", embedder)
    outcome = documents.select(key, F.col("error").alias("__error"), F.lit(True).alias("__done"))
    after = state.join(outcome, key, "left")
    failed = F.col("__error").isNotNull()
    values = {
        "sync_status": F.when(failed, "error").otherwise("synced"),
        "sync_error_count": F.when(failed, F.coalesce("sync_error_count", F.lit(0)) + 1).otherwise(0),
        "last_error_message": F.col("__error"),
    }
    kinds = dict(state.dtypes)
    after = after.withColumns({c: F.when(F.col("__done"), v.cast(kinds[c])).otherwise(F.col(c)) for c, v in values.items() if c in kinds})
    operations = documents.select(F.lit("add").alias("operation_type"), key, F.when(F.col("error").isNull(), "success").otherwise("failed").alias("status"), F.col("error").alias("error_message"))
    return Run(written(after.drop("__error", "__done"), "state"), documents, chunks, vectors, operations)


def run_pipeline(state: DataFrame, files: DataFrame, context: Callable[[Column], Column], embedder: Embedder, batch: int | None = None, retries: int = config.MAX_RETRIES, how: K.Cuts = K.Cuts()) -> Run:
    """Process until nothing is pending, ``batch`` files at a time (all at once where it is None), and those in error
    again until they have failed ``retries`` times."""
    parts: list[Run] = []
    while True:
        if not S.pending(state).limit(1).count():
            state = S.retry(state, retries)
            if not S.pending(state).limit(1).count():
                break
        run = process_pending(state, files, context, embedder, batch, how)
        parts.append(run)
        state = run.state
    if not parts:
        run = process_pending(state, files, context, embedder, batch, how)
        return Run(state, run.documents, run.chunks, run.vectors, run.operations)
    every = {n: getattr(parts[0], n) for n in ("documents", "chunks", "vectors", "operations")}
    for p in parts[1:]:
        every = {n: f.unionByName(getattr(p, n)) for n, f in every.items()}
    return Run(state, **every)
