"""The state of files: what a scan finds, what is to be done, upserts and cascades."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import config
from corpusloom.functions.context import is_supported


def scan_diff(listing: DataFrame, state: DataFrame, key: str = "file_path", digest: str = "file_hash", restore: bool = True, force: bool = False) -> DataFrame:
    """``key`` and ``change``: new, modified, unchanged, deleted, restored. Files already marked deleted and still
    absent are left out. Without ``restore`` a deleted file that is back unchanged stays as it is; ``force`` marks
    every known file as modified."""
    a, b = listing.select(key, F.col(digest).alias("now")), state.select(key, F.col(digest).alias("then"), "sync_status")
    both = a.withColumn("here", F.lit(True)).join(b.withColumn("known", F.lit(True)), key, "full_outer")
    gone = F.col("sync_status") == "deleted"
    back = F.when(gone & F.lit(restore), "restored")
    change = (
        F.when(F.col("known").isNull(), "new")
        .when(F.col("here").isNull(), F.when(~gone, "deleted"))
        .otherwise(F.coalesce(back, F.when(F.lit(force) | ~F.col("now").eqNullSafe(F.col("then")), "modified").otherwise("unchanged")))
    )
    return both.select(key, change.alias("change")).where("change IS NOT NULL")


def new_files(listing: DataFrame, state: DataFrame, key: str = "file_path") -> DataFrame:
    return listing.join(state.select(key), key, "left_anti")


def append_new(listing: DataFrame, state: DataFrame, key: str = "file_path", digest: str = "file_hash") -> DataFrame:
    """The state with a pending row for each listed file that it lacks; hidden files (a dot in front) are passed over."""
    found = listing.where(~F.startswith(F.element_at(F.split(key, "/"), -1), F.lit(".")))
    fresh = new_files(found, state, key).dropDuplicates([key])
    values = {key: F.col(key), digest: F.col(digest), "sync_status": F.lit("pending"), "sync_error_count": F.lit(0)}
    rows = fresh.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in state.schema.fields])
    return state.unionByName(rows)


def deleted_files(state: DataFrame, listing: DataFrame, key: str = "file_path") -> DataFrame:
    return state.where(F.col("sync_status") != "deleted").join(listing.select(key), key, "left_anti")


def pending(state: DataFrame, limit: int | None = None, key: str = "file_path") -> DataFrame:
    rows = state.where(F.col("sync_status") == "pending")
    return rows if limit is None else rows.orderBy(key).limit(limit)


def retry_candidates(state: DataFrame, most: int = config.MAX_RETRIES) -> DataFrame:
    return state.where((F.col("sync_status") == "error") & (F.col("sync_error_count") < most))


def stuck_files(state: DataFrame, as_of: Column, minutes: int | None = config.STUCK_MINUTES) -> DataFrame:
    """Files in processing since before so many minutes; all in processing if ``minutes`` is None."""
    rows = state.where(F.col("sync_status") == "processing")
    return rows if minutes is None else rows.where(F.col("updated_at") < as_of - F.make_dt_interval(mins=F.lit(minutes)))


def requeue(state: DataFrame, force: bool = False) -> DataFrame:
    """Files that are not synced, or all, are pending again."""
    return state.withColumn("sync_status", F.when(F.lit(force) | (F.col("sync_status") != "synced"), "pending").otherwise(F.col("sync_status")))


def retry(state: DataFrame, most: int = config.MAX_RETRIES) -> DataFrame:
    again = (F.col("sync_status") == "error") & (F.col("sync_error_count") < most)
    return state.withColumn("sync_status", F.when(again, "pending").otherwise(F.col("sync_status")))


def mark(state: DataFrame, keys: DataFrame, status: str, key: str = "file_path") -> DataFrame:
    """A new status for the named files."""
    named = keys.select(key).distinct().withColumn("__named", F.lit(True))
    return state.join(named, key, "left").withColumn("sync_status", F.when(F.col("__named"), status).otherwise(F.col("sync_status"))).drop("__named")


def upsert_documents(old: DataFrame, new: DataFrame, key: str = "file_path", ident: str = "id") -> DataFrame:
    """Known documents keep their ``ident`` and take the new values; unknown ones are added."""
    fields = [c for c in old.columns if c not in (key, ident)]
    renamed = new.select(key, F.col(ident).alias("__id"), *[F.col(c).alias(f"__{c}") for c in fields]).withColumn("__new", F.lit(True))
    both = old.join(renamed, key, "full_outer")
    return both.select(key, F.coalesce(ident, "__id").alias(ident), *[F.when(F.col("__new"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) for c in fields])


def cascade_delete(files: DataFrame, documents: DataFrame, chunks: DataFrame, vectors: DataFrame | None = None, vector: str = "vector_id") -> tuple[DataFrame, ...]:
    """What stays of files, documents and chunks (and vectors, where given) after files marked deleted go with all that
    hangs on them; a vector goes with the chunk that names it."""
    gone = files.where(F.col("sync_status") == "deleted").select("file_path")
    lost = documents.join(gone, "file_path", "left_semi").select("document_id")
    left = files.join(gone, "file_path", "left_anti"), documents.join(gone, "file_path", "left_anti"), chunks.join(lost, "document_id", "left_anti")
    if vectors is None:
        return left
    return *left, vectors.join(chunks.join(lost, "document_id", "left_semi").select(vector), vector, "left_anti")


def deletions(files: DataFrame) -> DataFrame:
    """The operations that a cascade logs: one for each file that goes."""
    return files.where(F.col("sync_status") == "deleted").select(F.lit("delete").alias("operation_type"), "file_path", F.lit("success").alias("status"))


# Statuses after events.
NEXT = {"created": "pending", "modified": "pending", "moved": "pending", "started": "processing", "succeeded": "synced", "failed": "error", "deleted": "deleted", "reset": "pending"}
#: Status, failures since the file was last synced, events seen, hash of the content that is known.
FileState = tuple[str | None, int, int, str | None]
NO_STATE: FileState = (None, 0, 0, None)


def advance(state: FileState, kind: str | None, digest: str | None) -> FileState:
    """The state after an event. A file that is known is not created again, content that is known is no change, an
    unknown file is not deleted, and other kinds of events say nothing."""
    status, errors, events, last = state
    known = status is not None
    if kind not in NEXT or (kind == "created" and known and status != "deleted") or (kind == "deleted" and not known):
        return status, errors, events + 1, last
    if kind == "modified" and known and digest is not None and digest == last:
        return status, errors, events + 1, last
    status = NEXT[kind]
    errors = errors + 1 if status == "error" else 0 if status == "synced" else errors
    return status, errors, events + 1, digest if digest is not None else last


def latest_status(events: DataFrame, key: str = "file_path", kind: str = "kind", ts: str = "ts", order: str = "event_id", digest: str = "file_hash") -> DataFrame:
    """The status of each file after all its events in order (``advance``), and its failures since it was last synced;
    files without a status are left out.

    Events pass one by one, so a task holds the state of one file, however many events it has.
    """
    rows = events.select(F.col(key).cast("string").alias("k"), F.col(kind).alias("kind"), F.col(digest).cast("string").alias("digest"), F.col(ts).alias("ts"), F.col(order).alias("seq"))
    dealt = rows.repartition("k").sortWithinPartitions("k", "ts", "seq").select("k", "kind", "digest")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [key, "sync_status", "sync_error_count"]
        out: list[tuple] = []
        file, state, first = None, NO_STATE, True
        for b in batches:
            for k, what, content in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if first or k != file:
                    out += [] if first else [(file, *state[:2])]
                    file, state, first = k, NO_STATE, False
                state = advance(state, what, content)
            yield _states(out, names)
            out = []
        if not first:
            yield _states([(file, *state[:2])], names)

    def _states(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
        cols = list(zip(*(r for r in rows if r[1] is not None), strict=True)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64()), strict=True)], names=names)

    return dealt.mapInArrow(fold, f"`{key}` string, sync_status string, sync_error_count long")


def relevant(events: DataFrame, key: str = "file_path") -> DataFrame:
    """Events of files with a supported suffix, told by the source path alone."""
    return events.where(is_supported(F.col(key)))


def split_moves(events: DataFrame) -> DataFrame:
    """Each move as two events: its source is deleted, its destination is pending."""
    moved = F.array(F.struct(F.col("file_path").alias("p"), F.lit("deleted").alias("k")), F.struct(F.col("dest_path").alias("p"), F.lit("moved").alias("k")))
    same = F.array(F.struct(F.col("file_path").alias("p"), F.col("kind").alias("k")))
    parts = events.withColumn("__e", F.explode(F.when(F.col("kind") == "moved", moved).otherwise(same)))
    return parts.withColumns({"file_path": F.col("__e.p"), "kind": F.col("__e.k")}).drop("__e")
