"""Vector collections: exact filtered search, batches of queries, upserts, deletes and payload merges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Numbers in the query block that workers hold (eight bytes each); larger query sets go in blocks of this size.
BLOCK_NUMBERS = 4_000_000
#: Rows and queries that are scored at once: a worker holds so many scores squared, however many queries a block has.
TILE = 1024
#: By how much a score from a product of matrices may differ from the sum in order.
MARGIN = 1e-9


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as the rows of a matrix."""
    if column.null_count or not len(column):
        return np.array(column.to_pylist(), dtype=np.float64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(_sum(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))))


def cosine(a: Column, b: Column) -> Column:
    """0 where a vector has no length."""
    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0))


#: Score, and whether the best come first in falling order. An unknown metric is cosine.
METRICS = {"cosine": (cosine, True), "dot": (dot, True), "euclidean": (euclidean, False)}


def matches(conditions: dict, list_mode: str = "any") -> Column:
    """Payload conditions, all of which hold: a value is equal; of a list any value, or with ``all`` every value."""
    out = F.lit(True)
    for name, value in conditions.items():
        if isinstance(value, list | tuple):
            one = F.col(name).isin(*value) if list_mode == "any" else None
            if one is None:
                one = F.lit(True)
                for v in value:
                    one = one & (F.col(name) == v)
            out = out & one
        elif isinstance(value, str | int | float | bool):
            out = out & (F.col(name) == value)
    return out


def search(
    vectors: DataFrame,
    query: list[float],
    limit: int | None = 10,
    metric: str = "cosine",
    threshold: float | None = None,
    where: Column | None = None,
    vector: str = "embedding",
    key: str = "vec_id",
    include_payload: bool = True,
    include_vector: bool = False,
) -> DataFrame:
    """The best ``limit`` rows with their ``score``; ties by key. A threshold is a least score, of distances a most.
    A limit of None gives every row, in no order."""
    score, falling = METRICS.get(metric, METRICS["cosine"])
    rows = vectors if where is None else vectors.where(where)
    rows = rows.withColumn("score", score(F.col(vector), F.array(*[F.lit(float(x)) for x in query])))
    if threshold is not None:
        rows = rows.where(F.col("score") >= threshold if falling else F.col("score") <= threshold)
    best = rows if limit is None else rows.orderBy(F.desc("score") if falling else F.asc("score"), key).limit(limit)
    best = best if include_vector else best.drop(vector)
    return best if include_payload else best.select(*[c for c in (key, "score", vector) if c in best.columns])


def vector_of(vectors: DataFrame, value, vector: str = "embedding", key: str = "vec_id") -> list[float]:
    found = vectors.where(F.col(key) == value).select(vector).first()
    if found is None:
        raise KeyError(value)
    return list(found[0])


def similar(vectors: DataFrame, value, limit: int = 5, exclude_self: bool = True, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """The rows nearest to a stored one, without it unless asked for."""
    query = vector_of(vectors, value, vector, key)
    return search(vectors, query, limit if exclude_self else limit + 1, where=F.col(key) != value if exclude_self else None, vector=vector, key=key)


def batch_search(vectors: DataFrame, queries: DataFrame, limit: int = 20, vector: str = "embedding", key: str = "vec_id", query_key: str = "query_id") -> DataFrame:
    """``query_id``, ``key``, ``score``, ``rank``: the best rows by cosine for each query; ties by key.

    Queries go to the workers in blocks of ``BLOCK_NUMBERS`` numbers, which the driver reads one after the other. A task
    scores its rows against a block by tiles of ``TILE`` rows and as many queries, and keeps the best of each query. So what a worker
    holds is the block, a tile and ``limit`` rows by query, what is shuffled is ``limit`` rows by query and task, and
    neither side is held whole anywhere. Scores near the best are computed again, number by number, so that equal vectors have
    equal scores wherever they stand.
    """
    id_kind = queries.schema[query_key].dataType.simpleString()
    kind = vectors.schema[key].dataType.simpleString()
    out = None

    def blocks() -> Iterator[list]:
        block, size = [], 0
        for r in queries.select(query_key, vector).toLocalIterator():
            block.append((r[0], np.array(r[1], dtype=np.float64)))
            size += len(r[1])
            if size >= BLOCK_NUMBERS:
                yield block
                block, size = [], 0
        yield block

    for block in blocks():
        if not block:
            nothing = vectors.select(F.lit(None).cast(id_kind).alias(query_key), key, F.lit(0.0).alias("score")).where(F.lit(False))
            out = nothing if out is None else out
            break
        shared = vectors.sparkSession.sparkContext.broadcast(([r[0] for r in block], np.stack([r[1] for r in block])))

        def score(batches: Iterator[pa.RecordBatch], shared=shared, tile=TILE) -> Iterator[pa.RecordBatch]:
            ids, wanted = shared.value
            lengths = np.sqrt((wanted * wanted).sum(axis=1))
            floor = np.full(len(ids), -np.inf)  # what a row must reach to be among the best of a query
            held, size = [], 0

            def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
                dots, aa, bb = np.zeros(len(a)), np.zeros(len(a)), np.zeros(len(a))
                for d in range(a.shape[1]):
                    x, y = a[:, d], b[:, d]
                    dots, aa, bb = dots + x * y, aa + x * x, bb + y * y
                both = np.sqrt(aa * bb)
                return np.divide(dots, both, out=np.zeros_like(dots), where=both > 0)

            def best() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
                q, s, keys = (np.concatenate(x) for x in zip(*held, strict=True))
                order = np.lexsort((np.unique(keys, return_inverse=True)[1], -s, q))
                q, s, keys = q[order], s[order], keys[order]
                at = np.arange(len(q)) - np.searchsorted(q, q)
                last = at == limit - 1
                floor[q[last]] = s[last]
                stay = at < limit
                return q[stay], s[stay], keys[stay]

            for b in batches:
                rows, names = matrix(b.column(1)), np.asarray(b.column(0))
                for r in range(0, b.num_rows, tile):
                    x, own = rows[r : r + tile], names[r : r + tile]
                    far = np.sqrt((x * x).sum(axis=1))
                    unit = np.divide(x, far[:, None], out=np.zeros_like(x), where=far[:, None] > 0)
                    for c in range(0, len(ids), tile):
                        n = lengths[c : c + tile, None]
                        s = np.divide(wanted[c : c + tile], n, out=np.zeros_like(wanted[c : c + tile]), where=n > 0) @ unit.T
                        least = floor[c : c + tile]
                        if s.shape[1] >= limit and np.isinf(least).any():
                            least = np.maximum(least, np.partition(s, s.shape[1] - limit, axis=1)[:, s.shape[1] - limit])
                        i, k = np.nonzero(s >= least[:, None] - MARGIN)
                        for a in range(0, len(i), 16 * tile):
                            i_, k_ = i[a : a + 16 * tile], k[a : a + 16 * tile]
                            held.append((i_ + c, exact(wanted[i_ + c], x[k_]), own[k_]))
                        size += len(i)
                        if size > 2 * limit * len(ids) + 200_000:
                            held = [best()]
                            size = len(held[0][0])
            if held:
                q, s, keys = best()
                for a in range(0, len(q), 50_000):
                    names = [ids[i] for i in q[a : a + 50_000].tolist()]
                    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(keys[a : a + 50_000]), pa.array(s[a : a + 50_000])], names=[query_key, key, "score"])

        part = vectors.select(key, vector).mapInArrow(score, f"{query_key} {id_kind}, {key} {kind}, score double")
        out = part if out is None else out.union(part)
    ranked = out.withColumn("rank", F.row_number().over(Window.partitionBy(query_key).orderBy(F.desc("score"), key)))
    return ranked.where(F.col("rank") <= limit)


def search_with_context(
    vectors: DataFrame, query: list[float], acronym: str | None = None, document_type: str | None = None, section: str | None = None, limit: int | None = 10, threshold: float = 0.7, **how
) -> DataFrame:
    """Search among the chunks of a manual, a type of document and a section; an empty or missing one does not filter."""
    wanted = {"policy_acronym": acronym, "document_type": document_type, "section": section}
    return search(vectors, query, limit, threshold=threshold, where=matches({k: v for k, v in wanted.items() if v}), **how)


def search_policies(vectors: DataFrame, query: list[float], acronym: str | None = None, document_type: str | None = None, limit: int | None = 10, threshold: float = 0.6, **how) -> DataFrame:
    """Search for documents by what they are about; a wider threshold, and no section."""
    return search_with_context(vectors, query, acronym, document_type, None, limit, threshold, **how)


def upsert(old: DataFrame, new: DataFrame, key: str = "vec_id") -> DataFrame:
    """Rows of ``new`` replace rows of ``old`` with the same key; the others stay."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def delete(vectors: DataFrame, keys: DataFrame, key: str = "vec_id") -> DataFrame:
    return vectors.join(keys.select(key), key, "left_anti")


def merge_payload(vectors: DataFrame, changes: DataFrame, key: str = "vec_id") -> DataFrame:
    """Fields that ``changes`` has and that are not null replace those of the collection."""
    fields = [c for c in changes.columns if c != key]
    new = changes.select(key, *[F.col(c).alias(f"__new_{c}") for c in fields])
    joined = vectors.join(new, key, "left")
    merged = [F.coalesce(F.col(f"__new_{c}"), F.col(c)).alias(c) if c in fields else F.col(c) for c in vectors.columns]
    return joined.select(*merged, *[F.col(f"__new_{c}").alias(c) for c in fields if c not in vectors.columns])


def collection_stats(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    return vectors.agg(F.count("*").alias("total_vectors"), F.max(F.size(vector)).alias("dimension"))


def vector_id(document: Column, index: Column, text: Column) -> Column:
    """An id from a chunk's document, number and content, so that a second run gives the same."""
    return F.sha2(F.concat_ws("|", document.cast("string"), index.cast("string"), F.substring(F.sha2(text, 256), 1, 16)), 256)


# Payload fields that a chunk's metadata fills, by name and type.
LIFTED = {
    "policy_acronym": "string", "policy_manual": "string", "section": "string", "subsection": "string", "document_type": "string",
    "synthetic_description": "boolean", "confidence_score": "double", "generated_keywords": "array<string>", "use_cases": "array<string>",
}


def _fields(metadata: Column, names: set[str], lifted: dict[str, str]) -> list[Column]:
    """Fields of a metadata struct; what it lacks is null."""
    return [(metadata[k] if k in names else F.lit(None)).cast(t).alias(k) for k, t in lifted.items()]


def chunk_payload(chunks: DataFrame, model: str = "hashing", created: Column | None = None) -> DataFrame:
    """What is stored with a chunk's vector, 18 fields after its ``vector_id``.

    ``chunks`` has ``doc_id``, ``chunk_index``, ``chunk_text``, and may have ``chunk_id``, ``document_index``,
    ``file_path``, ``page_numbers`` and the struct ``context_metadata``. Text is cut at 1000 characters; a missing number
    is 0, missing lists are empty, and a chunk is not synthetic unless its metadata says so.
    """
    have = set(chunks.columns)
    names = set(chunks.schema["context_metadata"].dataType.names) if "context_metadata" in have else set()
    own = lambda c, kind: (F.col(c) if c in have else F.lit(None)).cast(kind)
    empty = F.array().cast("array<string>")
    rows = chunks.withColumn("__id", vector_id(F.col("doc_id"), F.col("chunk_index"), F.col("chunk_text")))
    lifted = rows.select(
        F.col("__id").alias("vector_id"),
        F.coalesce(own("chunk_id", "string"), F.col("__id")).alias("chunk_id"),
        F.col("doc_id").alias("document_id"),
        own("document_index", "string").alias("document_index"),
        F.substring("chunk_text", 1, 1000).alias("text"),
        F.coalesce("chunk_index", F.lit(0)).alias("chunk_index"),
        *_fields(F.col("context_metadata") if names else F.lit(None), names, LIFTED),
        own("file_path", "string").alias("file_path"),
        F.coalesce(own("page_numbers", "array<int>"), F.array().cast("array<int>")).alias("page_numbers"),
        (created if created is not None else F.current_timestamp()).alias("created_at"),
        F.lit(model).alias("embedding_model"),
    )
    return lifted.withColumns({
        "synthetic_description": F.coalesce("synthetic_description", F.lit(False)),
        "generated_keywords": F.coalesce("generated_keywords", empty),
        "use_cases": F.coalesce("use_cases", empty),
    })


def nested_payload(chunks: DataFrame) -> DataFrame:
    """The payload that keeps a chunk whole: 11 fields after ``vector_id``, metadata as a struct, text and Markdown in full.

    ``chunks`` has the columns of ``chunking.chunk_documents``.
    """
    ident = vector_id(F.col("doc_id"), F.col("chunk_index"), F.col("chunk_text"))
    return chunks.select(
        ident.alias("vector_id"),
        ident.alias("chunk_id"),
        F.col("doc_id").alias("document_id"),
        F.col("context_metadata.file_path").alias("file_path"),
        F.col("context_metadata.document_index").alias("document_index"),
        "section_title",
        "context_metadata",
        F.array().cast("array<int>").alias("page_numbers"),
        "chunk_text",
        "chunk_markdown",
        "token_count",
        F.col("position").alias("document_position"),
    )
