"""Queries over collections, payloads, whole documents, runs and evaluations, each with its SQL where SQL expresses it."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom import config
from corpusloom.functions import cleaning as C
from corpusloom.functions import context as X
from corpusloom.functions import describe as D
from corpusloom.operators import chunking as K
from corpusloom.operators import collections as O
from corpusloom.operators import embedding as M
from corpusloom.operators import evaluate as V
from corpusloom.operators import run as N
from corpusloom.operators import state as S
from corpusloom.operators import vectors as W
from corpusloom.plans import queries as Q
from corpusloom.plans import reports as R
from corpusloom.plans.registry import Registry
from corpusloom.session import scratch_path, table
from corpusloom.sources import documents as P

_R = Registry()
_query, queries, oracle_sql = _R.query, _R.queries, _R.oracle_sql

# ---------------------------------------------------------------- searches and payloads

_CODE = "CASE vec_id % 3 WHEN 0 THEN 'ADM' WHEN 1 THEN 'CARE' ELSE 'EPM' END"
_KIND = "CASE vec_id % 2 WHEN 0 THEN 'policy' ELSE 'form' END"
_PART = "CASE vec_id % 5 WHEN 0 THEN 'Part A' ELSE 'Part B' END"
_SCORED = f"s AS (SELECT vec_id, label, {_CODE} AS policy_acronym, {_KIND} AS document_type, {_PART} AS section, {Q._COS} AS score FROM embeddings)"


def _stored(spark: SparkSession, sf: str) -> DataFrame:
    return Q._vectors(spark, sf).withColumns({"policy_acronym": F.expr(_CODE), "document_type": F.expr(_KIND), "section": F.expr(_PART)})


@_query(f"""WITH {_SCORED} SELECT vec_id, policy_acronym, section, round(score, 6) AS score FROM s WHERE policy_acronym = 'CARE' AND document_type = 'form' AND section = 'Part B' AND score >= 0.7 ORDER BY score DESC, vec_id LIMIT 10""")
def search_with_context(spark: SparkSession, sf: str) -> DataFrame:
    found = W.search_with_context(_stored(spark, sf), Q._seventh(spark, sf), "CARE", "form", "Part B")
    return found.select("vec_id", "policy_acronym", "section", F.round("score", 6).alias("score"))


@_query(f"""WITH {_SCORED} SELECT vec_id, policy_acronym, document_type, round(score, 6) AS score FROM s WHERE document_type = 'form' AND score >= 0.6 ORDER BY score DESC, vec_id LIMIT 10""")
def search_policy_documents(spark: SparkSession, sf: str) -> DataFrame:
    found = W.search_policies(_stored(spark, sf), Q._seventh(spark, sf), "", "form")
    return found.select("vec_id", "policy_acronym", "document_type", F.round("score", 6).alias("score"))


@_query(f"SELECT vec_id, round({Q._COS}, 6) AS score, CAST(len(embedding) AS INTEGER) AS n FROM embeddings ORDER BY {Q._COS} DESC, vec_id LIMIT 7")
def vector_projection(spark: SparkSession, sf: str) -> DataFrame:
    """A search that leaves the payload and gives the vectors."""
    found = W.search(Q._vectors(spark, sf), Q._seventh(spark, sf), 7, include_payload=False, include_vector=True)
    return found.select("vec_id", F.round("score", 6).alias("score"), F.size("embedding").alias("n"))


# ---------------------------------------------------------------- collections


def _collections(spark: SparkSession) -> O.Collections:
    return O.Collections(spark, scratch_path(spark, "collections"))


@_query("""SELECT * FROM (VALUES ('documents_hashing', 64, 'cosine', (SELECT CAST(count(*) AS BIGINT) FROM embeddings)), ('documents_far', 64, 'euclidean', (SELECT CAST(count(*) AS BIGINT) FROM embeddings WHERE vec_id % 2 = 0)),
 ('documents_empty', 8, 'cosine', CAST(0 AS BIGINT))) AS v(name, dimension, metric, vectors)""")
def collection_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    """Collections made, filled, refused where the name is taken, and cleaned up; then listed."""
    c, v = _collections(spark), Q._vectors(spark, sf)
    c.create_for("hashing", 64)
    c.create_for("far", 64, "Euclidean")
    c.create("documents_empty", 8, "no such metric")
    c.create("documents_empty", 9)
    c.create("old", 64)
    c.add("documents_hashing", v, "embedding", "vec_id")
    c.add("documents_far", v.where("vec_id % 2 = 0"), "embedding", "vec_id")
    c.cleanup("documents_")
    return c.listing()


@_query("""WITH a AS (SELECT vec_id, label FROM embeddings WHERE vec_id % 2 = 0), b AS (SELECT vec_id, label + 100 AS label FROM embeddings WHERE vec_id % 3 = 0)
SELECT CAST(vec_id AS VARCHAR) AS id, label FROM b UNION ALL SELECT CAST(vec_id AS VARCHAR), label FROM a WHERE vec_id NOT IN (SELECT vec_id FROM b)""")
def add_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Two additions of which the second replaces what the first has too."""
    c, v = _collections(spark), Q._vectors(spark, sf)
    c.create("own", 64)
    c.add("own", v.where("vec_id % 2 = 0"), "embedding", "vec_id")
    c.add("own", v.where("vec_id % 3 = 0").withColumn("label", F.col("label") + 100), "embedding", "vec_id")
    return c.read("own").select("id", "label")


@_query("""SELECT CAST(vec_id AS VARCHAR) AS id, CASE WHEN vec_id % 5 = 0 THEN label + 7 ELSE label END AS label, round(CASE WHEN vec_id % 7 = 0 THEN 1.0 ELSE CAST(embedding[1] AS DOUBLE) END, 6) AS head,
 CASE WHEN vec_id % 7 = 0 THEN 'moved' END AS note FROM embeddings WHERE vec_id % 11 <> 0""")
def update_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Payload merged into some points, others replaced whole, some deleted."""
    c, v = _collections(spark), Q._vectors(spark, sf)
    c.create("own", 64)
    c.add("own", v, "embedding", "vec_id")
    ident = F.col("vec_id").cast("string").alias("id")
    c.update("own", v.where("vec_id % 5 = 0").select(ident, (F.col("label") + 7).alias("label")))
    ones = F.array_repeat(F.lit(1.0), 64).alias("vector")
    label = F.when(F.expr("vec_id % 5 = 0"), F.col("label") + 7).otherwise(F.col("label")).alias("label")
    c.update("own", v.where("vec_id % 7 = 0").select(ident, ones, label, F.lit("moved").alias("note")))
    c.remove("own", v.where("vec_id % 11 = 0").select(ident))
    return c.read("own").select("id", "label", F.round(F.get("vector", F.lit(0)).cast("double"), 6).alias("head"), "note")


_MODELS = ", ".join(f"('{k}', 'documents_{k}', '{p}', '{m}', {d}, {c!r}::DOUBLE, {b})" for k, (p, m, d, c, b) in O.MODELS.items())


@_query(f"""SELECT *, CAST(0 AS BIGINT) AS vectors, model_key = 'dense_mini384' AS "exists" FROM (VALUES {_MODELS})
 AS v(model_key, collection, provider, model_name, dimension, cost_per_1k, batch_size)""")
def model_registry(spark: SparkSession, sf: str) -> DataFrame:
    """The models beside the collections that there are."""
    c = _collections(spark)
    O.create_model(c, "dense_mini384")
    O.create_model(c, "no such model")
    c.create("other", 3)
    return O.with_collections(O.models(spark), c.listing())


# ---------------------------------------------------------------- whole documents

#: Texts of which every ninth has no content; paths and contexts are those of the other queries.
_TEXT = f"CASE WHEN doc_id % 9 = 0 THEN '  ' ELSE {Q.RAW} END"


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return Q._docs(spark, sf).select("doc_id", "n_chars", F.expr(Q.PATH).alias("path"), F.expr(_TEXT).alias("content"))


def _whole(spark: SparkSession, sf: str) -> DataFrame:
    return K.chunk_documents(_documents(spark, sf), X.context(F.col("path"), Q.ROOT), "doc_id", "content", path=F.col("path"), size=F.col("n_chars") * 100, how=Q._LOSSLESS)


_DESCRIPTION = f"concat({Q._sql_template()}, coalesce(' This document is used within the ' || section || ' section.', ''), coalesce(' Document reference: ' || idx || '.', ''))"
_WORDS_OF = Q._KEYWORDS.removesuffix(", ' ')") + ", ', ')"
_USES_OF = Q._USECASES.removesuffix(", ',')") + ", ', ')"
_SEARCHABLE = f"""concat({_DESCRIPTION}, ' This ', form, ' can be used for: ', {_USES_OF}, '. Related keywords: ', {_WORDS_OF}, '. Filename: ', file_name, coalesce(' Document ID: ' || idx, ''))"""
_CONFIDENCE = """round(least(1.0, 0.5 + 0.1 + (section IS NOT NULL)::INT * 0.1 + (idx IS NOT NULL)::INT * 0.1 + regexp_matches(lower(file_name), 'checklist|template|form')::INT * 0.15
 + CASE WHEN n_chars * 100 > 10000 AND n_chars * 100 < 500000 THEN 0.1 WHEN n_chars * 100 > 500000 THEN 0.05 ELSE 0 END)::DOUBLE, 6)"""


_EMPTY = f"em AS (SELECT doc_id FROM documents WHERE doc_id % 9 = 0 OR length({Q._STRIP.format(Q.RAW)}) < 10)"


@_query(f"WITH {Q._FORMS}, {_EMPTY} SELECT doc_id, form AS document_type, {_CONFIDENCE} AS confidence, {_SEARCHABLE} AS chunk_text FROM z SEMI JOIN em USING (doc_id)")
def synthetic_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """The chunks of documents without content."""
    d = _documents(spark, sf)
    found = K.synthetic_chunks(d, "doc_id", "content", X.context(F.col("path"), Q.ROOT), F.col("n_chars") * 100)
    return found.select("doc_id", "described.document_type", F.round("described.confidence_score", 6).alias("confidence"), "chunk_text")


_CHUNKED = f"""{Q._cut_sql(Q._LOSSLESS)}, {Q._FORMS}, {_EMPTY},
every AS (SELECT doc_id, chunk_index, chunk_text, char_start, char_end, chunk_text AS md, kind AS document_type, false AS synthetic FROM k JOIN z USING (doc_id) ANTI JOIN em USING (doc_id)
 UNION ALL SELECT doc_id, 0, t, 0, length(t), '# ' || file_name || chr(10) || chr(10) || t, form, true FROM (SELECT *, {_SEARCHABLE} AS t FROM z SEMI JOIN em USING (doc_id)))""".replace("every AS (SELECT doc_id, p, n, e", "all_cuts AS (SELECT doc_id, p, n, e").replace("FROM every JOIN t", "FROM all_cuts JOIN t")


@_query(f"""WITH RECURSIVE {_CHUNKED} SELECT doc_id, chunk_index, sha256(chunk_text) AS digest, CAST(char_start AS INTEGER) AS char_start, CAST(char_end AS INTEGER) AS char_end, CAST({Q._TOKENS.format("chunk_text")} AS INTEGER) AS token_count,
 document_type, synthetic, array_to_string(list_filter([CASE WHEN contains(md, '|') AND contains(md, '-') THEN 'table' END, CASE WHEN regexp_matches(md, '(?m)^\\s*[-*+]\\s') THEN 'list' END,
 CASE WHEN regexp_matches(md, '(?m)^#{{1,6}}\\s') THEN 'heading' END], lambda x: x IS NOT NULL), ',') AS elements FROM every""")
def chunk_document(spark: SparkSession, sf: str) -> DataFrame:
    """Documents to chunks: boundaries of four families, described forms, metadata."""
    m = F.col("context_metadata")
    return _whole(spark, sf).select(
        "doc_id", "chunk_index", F.sha2("chunk_text", 256).alias("digest"), "char_start", "char_end", "token_count",
        m["document_type"].alias("document_type"), m["synthetic_description"].alias("synthetic"), F.array_join(m["structural_elements"], ",").alias("elements"),
    )


_SMALL = K.Cuts(size=30, overlap=4, minimum=8, limit=40, lossless=True, fallback="chars")


@_query(f"""WITH RECURSIVE {Q._cut_sql(_SMALL)}, tk AS (SELECT doc_id, chunk_index, chunk_text, char_start, char_end, regexp_extract_all(chunk_text, '[\\p{{L}}\\p{{N}}\\p{{M}}_]+|[^\\p{{L}}\\p{{N}}\\p{{M}}_\\s]') AS w FROM k),
pc AS (SELECT doc_id, chunk_index, char_start, char_end, 0 AS j, chunk_text AS body FROM tk WHERE length(chunk_text) <= 40 OR len(w) <= 40
 UNION ALL SELECT doc_id, chunk_index, char_start, char_end, j, array_to_string(w[j * 30 + 1 : j * 30 + 30], ' ') FROM (SELECT *, unnest(range(0, CAST(ceil(len(w) / 30.0) AS BIGINT))) AS j FROM tk WHERE length(chunk_text) > 40 AND len(w) > 40))
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY chunk_index, j) - 1 AS INTEGER) AS chunk_index, sha256(body) AS digest, char_start, char_end FROM pc""")
def chunk_resplit(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks over the limit of tokens are cut again; the pieces keep the place of the whole."""
    return Q._chunks(spark, sf, _SMALL).select("doc_id", "chunk_index", F.sha2("chunk_text", 256).alias("digest"), "char_start", "char_end")


@_query(f"""WITH RECURSIVE {_CHUNKED} SELECT sha256(concat_ws('|', doc_id, chunk_index, sha256(chunk_text)[1:16])) AS vector_id, doc_id AS document_id, chunk_index, length(substr(chunk_text, 1, 1000)) AS n, z.acronym AS policy_acronym, z.m AS policy_manual,
 z.section, NULL::VARCHAR AS subsection, document_type, z.path AS file_path, synthetic AS synthetic_description, CASE WHEN synthetic THEN {_CONFIDENCE} END AS confidence_score,
 CASE WHEN synthetic THEN {Q._KEYWORDS} ELSE '' END AS keywords, CASE WHEN synthetic THEN {Q._USECASES} ELSE '' END AS uses, 'hashing' AS embedding_model FROM every JOIN z USING (doc_id)""")
def chunk_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """What is stored with each chunk's vector."""
    chunks = _whole(spark, sf).withColumn("file_path", F.col("context_metadata.file_path"))
    p = W.chunk_payload(chunks)
    names = ["vector_id", "document_id", "chunk_index", "policy_acronym", "policy_manual", "section", "subsection", "document_type", "file_path", "synthetic_description", "embedding_model"]
    return p.select(*names, F.char_length("text").cast("long").alias("n"), F.round("confidence_score", 6).alias("confidence_score"), F.array_join("generated_keywords", " ").alias("keywords"), F.array_join("use_cases", ",").alias("uses"))


@_query(f"""WITH RECURSIVE {_CHUNKED} SELECT doc_id AS document_id, z.path AS file_path, z.idx AS document_index, nullif(regexp_extract(md, '(?m)^#{{1,6}}[ \\t]+(.+)$', 1), '') AS section_title, sha256(chunk_text) AS digest, length(md) AS markdown,
 z.m AS manual, CAST({Q._TOKENS.format("chunk_text")} AS INTEGER) AS token_count FROM every JOIN z USING (doc_id)""")
def nested_payloads(spark: SparkSession, sf: str) -> DataFrame:
    p = W.nested_payload(_whole(spark, sf))
    return p.select("document_id", "file_path", "document_index", "section_title", F.sha2("chunk_text", 256).alias("digest"), F.char_length("chunk_markdown").cast("long").alias("markdown"), F.col("context_metadata.policy_manual").alias("manual"), "token_count")


@_query(f"""WITH {Q._CTX} SELECT doc_id, path AS file_path, rel AS relative_path, 'policy_document' AS source_type, 'healthcare_policy' AS content_domain, 'Example Homes' AS organization,
 parts[1:len(parts) - 1][1] AS level_0, parts[1:len(parts) - 1][2] AS level_1, parts[1:len(parts) - 1][3] AS level_2, parts[1:len(parts) - 1][4] AS level_3, acronym AS policy_acronym FROM x""")
def context_metadata(spark: SparkSession, sf: str) -> DataFrame:
    rows = _documents(spark, sf)
    m = X.metadata(F.col("path"), X.context(F.col("path"), Q.ROOT), config.Organisation().short)
    found = rows.select("doc_id", m.alias("m"))
    return found.select("doc_id", "m.file_path", "m.relative_path", "m.source_type", "m.content_domain", "m.organization", "m.hierarchy.*", "m.policy_acronym")


@_query(f"""WITH w AS (SELECT doc_id, text, regexp_extract_all(text, '[\\p{{L}}\\p{{N}}\\p{{M}}_]+|[^\\p{{L}}\\p{{N}}\\p{{M}}_\\s]') AS t FROM documents)
SELECT doc_id, CAST(len(t) AS INTEGER) AS tokens, CAST(greatest(1, ceil(len(t) / 100.0)) AS INTEGER) AS parts, sha256(CASE WHEN len(t) <= 100 THEN text ELSE array_to_string(t[1:100], ' ') END) AS first_part FROM w""")
def split_by_tokens(spark: SparkSession, sf: str) -> DataFrame:
    t = K.tokenized(Q._docs(spark, sf), "doc_id", "text", K.WordTokenizer(), 100)
    return t.select("doc_id", "tokens", F.size("parts").alias("parts"), F.sha2(F.get("parts", F.lit(0)), 256).alias("first_part"))


# ---------------------------------------------------------------- cleaning


@_query(Q._ngram_sql("").replace("SELECT", "SELECT", 1) + " ORDER BY occurrences DESC, phrase LIMIT 200")
def phrases_by_count(spark: SparkSession, sf: str) -> DataFrame:
    """The 200 most common phrases, the first ones first."""
    return C.phrase_counts(Q._numbered(spark, sf), F.col("text"), "doc_id", top=200)


@_query(f"SELECT * FROM ({Q._ngram_sql('')}) WHERE occurrences >= floor((SELECT count(*) FROM documents) * 0.5)")
def frequent_noise_occurrences(spark: SparkSession, sf: str) -> DataFrame:
    """Phrases that occur at least half as often as there are documents."""
    n = Q._docs(spark, sf).count()
    return C.frequent_noise(C.phrase_counts(Q._numbered(spark, sf), F.col("text"), "doc_id", least=n // 2), n, 0.5)


_REPEATED = f"""{Q._sql_headers(Q.RAW)}, rp AS (SELECT DISTINCT doc_id, s, k FROM ct WHERE s <> '' AND k > 3)"""


@_query(f"""WITH {_REPEATED} SELECT doc_id, 'repeated_line' AS kind, s AS pattern, CAST(k AS INTEGER) AS count FROM rp""")
def repeated_lines_removed(spark: SparkSession, sf: str) -> DataFrame:
    rows = Q._raw(spark, sf).select("doc_id", F.explode(C.header_counts(F.col("raw"))).alias("c")).select("doc_id", "c.*")
    return rows.where("kind = 'repeated_line'")


_FIRST = "CASE " + " ".join(f"WHEN regexp_matches(s, '(?i)^(?:{p.removeprefix('^')})') THEN '{p}'" for p in config.HEADER_PATTERNS) + " END"


@_query(f"""WITH {_REPEATED}, hd AS (SELECT doc_id, {_FIRST} AS pattern FROM ct WHERE s <> '' AND k <= 3) SELECT doc_id, 'header_footer' AS kind, pattern, CAST(count(*) AS INTEGER) AS count FROM hd WHERE pattern IS NOT NULL GROUP BY doc_id, pattern""")
def headers_removed(spark: SparkSession, sf: str) -> DataFrame:
    rows = Q._raw(spark, sf).select("doc_id", F.explode(C.header_counts(F.col("raw"))).alias("c")).select("doc_id", "c.*")
    return rows.where("kind = 'header_footer'")


# ---------------------------------------------------------------- state and runs


@_query(f"""WITH {Q._SOME}, l AS (SELECT CASE WHEN o_orderkey % 17 = 0 THEN concat('.f', o_orderkey) ELSE concat('f', o_orderkey) END AS file_path FROM orders WHERE o_orderkey % 13 <> 0),
a AS (SELECT file_path, sync_status FROM s UNION ALL SELECT file_path, 'pending' FROM l WHERE file_path NOT IN (SELECT file_path FROM s) AND file_path NOT LIKE '.%')
SELECT sync_status, CAST(count(*) AS BIGINT) AS n FROM a GROUP BY 1""")
def mirror_append(spark: SparkSession, sf: str) -> DataFrame:
    """New files added to the state as pending; hidden ones passed over."""
    hidden = F.when(F.expr("substring(file_path, 2) % 17 = 0"), F.concat(F.lit("."), F.col("file_path"))).otherwise(F.col("file_path"))
    listing = Q._listing(spark, sf).withColumn("file_path", hidden)
    return R.status_counts(S.append_new(listing, Q._some(spark, sf)))


@_query(f"WITH {Q._S} SELECT CASE WHEN sync_status = 'processing' THEN 'pending' ELSE sync_status END AS sync_status, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY 1")
def reset_stuck(spark: SparkSession, sf: str) -> DataFrame:
    """Every file in processing is pending again, however long it has been."""
    s = Q._state(spark, sf)
    return R.status_counts(S.mark(s, S.stuck_files(s, F.current_timestamp(), None), "pending"))


@_query(f"WITH {Q._S} SELECT 'pending' AS sync_status, CAST(count(*) AS BIGINT) AS n FROM s")
def reset_all(spark: SparkSession, sf: str) -> DataFrame:
    return R.status_counts(S.requeue(Q._state(spark, sf), force=True))


@_query("""WITH f AS (SELECT o_orderkey FROM orders WHERE o_orderkey % 6 = 3), k AS (SELECT l_orderkey, l_orderkey * 10 + l_linenumber AS vector_id FROM lineitem)
SELECT (SELECT CAST(count(*) AS BIGINT) FROM k WHERE l_orderkey NOT IN (SELECT o_orderkey FROM f)) AS chunks, (SELECT CAST(count(DISTINCT vector_id) AS BIGINT) FROM k WHERE l_orderkey NOT IN (SELECT o_orderkey FROM f)) AS vectors,
 (SELECT CAST(count(*) AS BIGINT) FROM f) AS operations""")
def cascade_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Deleted files take their documents, chunks and vectors along, and leave an operation each."""
    orders = table(spark, sf, "orders")
    files = orders.select(F.col("o_orderkey").alias("file_path"), F.when(F.expr("o_orderkey % 6 = 3"), "deleted").otherwise("synced").alias("sync_status"))
    docs = orders.select(F.col("o_orderkey").alias("file_path"), F.col("o_orderkey").alias("document_id"))
    chunks = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("document_id"), F.expr("l_orderkey * 10 + l_linenumber").alias("vector_id"))
    _, _, left, vectors = S.cascade_delete(files, docs, chunks, chunks.select("vector_id").distinct())
    counts = [f.agg(F.count("*").alias(n)) for f, n in ((left, "chunks"), (vectors, "vectors"), (S.deletions(files), "operations"))]
    return counts[0].join(counts[1]).join(counts[2])


@_query(f"""WITH {Q._CLEANED} SELECT CASE WHEN doc_id % 10 = 3 THEN 'error' ELSE 'synced' END AS sync_status, CAST(CASE WHEN doc_id % 10 = 3 THEN 3 ELSE 0 END AS BIGINT) AS sync_error_count, CAST(count(*) AS BIGINT) AS files,
 CAST(count(*) FILTER ((doc_id % 9 = 0 OR length(cleaned) < 10) AND doc_id % 10 <> 3) AS BIGINT) AS described FROM c GROUP BY 1, 2""")
def run_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """Runs until nothing is pending: files that fail are tried three times, files without content get a description."""
    d = Q._docs(spark, sf).where("doc_id IS NOT NULL")
    path = F.concat(F.expr(Q.PATH), F.lit("#"), F.col("doc_id").cast("string"))
    files = d.select(path.alias("file_path"), F.expr(_TEXT).alias("text"), F.expr("CASE WHEN doc_id % 10 = 3 THEN 'Failed to parse' END").alias("error"))
    state = d.select(path.alias("file_path"), F.lit("pending").alias("sync_status"), F.lit(0).cast("long").alias("sync_error_count"), F.lit(None).cast("string").alias("last_error_message"))
    run = N.run_pipeline(state, files, lambda p: X.context(p, Q.ROOT), M.HashingEmbedder())
    described = run.chunks.where("context_metadata.synthetic_description").select(F.col("doc_id").alias("file_path"), F.lit(1).alias("one"))
    return run.state.join(described, "file_path", "left").groupBy("sync_status", "sync_error_count").agg(F.count("*").alias("files"), F.count("one").alias("described"))


# ---------------------------------------------------------------- reports


@_query(f"WITH {Q._S} SELECT file_path, last_error_message FROM s WHERE sync_status = 'error' ORDER BY updated_at DESC, file_path DESC LIMIT 3")
def recent_errors(spark: SparkSession, sf: str) -> DataFrame:
    return R.recent_errors(Q._state(spark, sf)).select("file_path", "last_error_message")


@_query(f"WITH {Q._S} SELECT file_path, updated_at FROM s WHERE sync_status = 'processing' ORDER BY updated_at DESC, file_path DESC LIMIT 5")
def recent_processing(spark: SparkSession, sf: str) -> DataFrame:
    return R.recent_processing(Q._state(spark, sf)).select("file_path", "updated_at")


@_query(f"""WITH {Q._S}, c AS (SELECT CAST(count(*) FILTER (sync_status = 'synced') AS DOUBLE) AS synced, CAST(count(*) FILTER (sync_status = 'pending') AS DOUBLE) AS pending, CAST(count(*) AS DOUBLE) AS total FROM s)
SELECT round((SELECT count(*) FROM lineitem) / synced * total, 4) AS vectors, round(pending / (12.5 * 60), 6) AS hours_remaining, TIMESTAMP '2024-01-01 00:00:00' + to_microseconds(CAST(trunc(pending / (12.5 * 60) * 3600e6) AS BIGINT)) AS eta FROM c""")
def completion_estimate(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors to expect, and when the pending files will be done at a given rate."""
    counts = Q._state(spark, sf).agg(F.count_if(F.col("sync_status") == "synced").alias("synced"), F.count_if(F.col("sync_status") == "pending").alias("pending"), F.count("*").alias("total"))
    rows = counts.join(table(spark, sf, "lineitem").agg(F.count("*").alias("vectors")))
    e = R.eta(F.col("pending"), F.lit(12.5), F.lit("2024-01-01 00:00:00").cast("timestamp"))
    found = rows.select(F.round(R.vector_estimate(F.col("vectors"), F.col("synced"), F.col("total")), 4).alias("vectors"), e.alias("e"))
    return found.select("vectors", F.round("e.hours_remaining", 6).alias("hours_remaining"), F.col("e.eta").cast("timestamp_ntz").alias("eta"))


@_query(f"WITH RECURSIVE {Q._cut_sql(Q._LOSSLESS)} SELECT round(avg(n), 6) AS avg_tokens, CAST(min(n) AS INTEGER) AS min_tokens, CAST(max(n) AS INTEGER) AS max_tokens FROM (SELECT {Q._TOKENS.format('chunk_text')} AS n FROM k)")
def chunk_token_stats(spark: SparkSession, sf: str) -> DataFrame:
    sized = Q._chunks(spark, sf, Q._LOSSLESS).withColumn("token_count", K.token_count(F.col("chunk_text")))
    return R.token_stats(sized).withColumn("avg_tokens", F.round("avg_tokens", 6))


@_query(f"WITH {Q._S} SELECT sync_status, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY 1")
def report_sink(spark: SparkSession, sf: str) -> DataFrame:
    """A report written as JSON lines and read back."""
    path = scratch_path(spark, "report")
    P.write_report(R.status_counts(Q._state(spark, sf)), path)
    return spark.read.schema("sync_status string, n long").json(path)


# ---------------------------------------------------------------- files

_W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def _word_file(name: str, key: int) -> bytes:
    """A small Word file: a heading, a line with a bold word, a table."""
    run = lambda t, style="": f'<w:r>{style}<w:t xml:space="preserve">{escape(t)}</w:t></w:r>'
    row = lambda *cells: "<w:tr>" + "".join(f"<w:tc><w:p>{run(c)}</w:p></w:tc>" for c in cells) + "</w:tr>"
    head = f'<w:p><w:pPr><w:pStyle w:val="Heading2"/></w:pPr>{run(name)}</w:p>'
    body = f"{head}<w:p>{run('Key', '<w:rPr><w:b/></w:rPr>')}{run(f' {key}')}</w:p><w:tbl>{row('a', name)}{row('b', str(key))}</w:tbl>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{_W}"><w:body>{body}</w:body></w:document>')
    return out.getvalue()


@_query("""WITH n AS (SELECT n_name AS m, CAST(n_nationkey AS VARCHAR) AS k, n_nationkey, greatest(length(n_name), length(CAST(n_nationkey AS VARCHAR))) AS w FROM nation)
SELECT 'd' || k || CASE WHEN n_nationkey % 5 = 4 THEN '.odt' ELSE '.docx' END AS file_path, CASE WHEN n_nationkey % 5 < 3 THEN '## ' || m || chr(10) || chr(10) || '**Key** ' || k || chr(10) || '| a | ' || rpad(m, CAST(w AS INTEGER), ' ') || ' |' || chr(10)
 || '| - | ' || repeat('-', w) || ' |' || chr(10) || '| b | ' || rpad(k, CAST(w AS INTEGER), ' ') || ' |' || chr(10) || chr(10) END AS markdown, CASE WHEN n_nationkey % 5 < 3 THEN 'Key ' || k END AS raw_text,
 CAST(CASE WHEN n_nationkey % 5 < 3 THEN 2 ELSE 0 END AS INTEGER) AS word_count, n_nationkey % 5 < 3 AS parsing_success, n_nationkey % 5 = 4 AS unsupported FROM n""")
def parse_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Word files made from a table and parsed: some are broken, some of a kind that no parser is for."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = list(zip(b.column("n_nationkey").to_pylist(), b.column("n_name").to_pylist(), strict=True))
            paths = [f"d{k}" + (".odt" if k % 5 == 4 else ".docx") for k, _ in rows]
            contents = [b"broken" if k % 5 == 3 else _word_file(n, k) for k, n in rows]
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], names=["file_path", "content"])

    files = table(spark, sf, "nation").select("n_nationkey", "n_name").mapInArrow(make, "file_path string, content binary")
    parsed = P.parse_documents(files)
    return parsed.select("file_path", "markdown", "raw_text", "word_count", "parsing_success", F.coalesce(F.startswith("error", F.lit("Unsupported")), F.lit(False)).alias("unsupported"))


# ---------------------------------------------------------------- evaluation


@_query("SELECT p AS provider, round(1000.0 / s, 6)::DOUBLE AS avg_embedding_time_ms, 1.0::DOUBLE AS avg_search_time_ms, s AS embeddings_per_second FROM (VALUES ('sentence_transformers', 100.0::DOUBLE), ('openai', 50.0::DOUBLE), ('cohere', 30.0::DOUBLE), ('other', 50.0::DOUBLE)) AS v(p, s)")
def performance_constants(spark: SparkSession, sf: str) -> DataFrame:
    rows = spark.createDataFrame([(p,) for p in ("sentence_transformers", "openai", "cohere", "other")], "provider string")
    return rows.select("provider", V.performance(F.col("provider")).alias("p")).select("provider", F.round("p.avg_embedding_time_ms", 6).alias("avg_embedding_time_ms"), "p.avg_search_time_ms", "p.embeddings_per_second")


_TESTS = ", ".join(f"('{i}', '{t}', '{k}', '{','.join(s)}', '{d}')" for k, found in V.TEST_QUERIES.items() for i, t, s, d in found)


@_query(f"SELECT * FROM (VALUES {_TESTS}) AS v(query_id, text, query_type, sections, difficulty)")
def test_query_table(spark: SparkSession, sf: str) -> DataFrame:
    return V.test_queries(spark).withColumn("sections", F.array_join("expected_sections", ",")).drop("expected_sections")


@_query(f"""WITH {Q._CTX}, t AS (SELECT * FROM (VALUES {_TESTS}) AS v(query_id, text, query_type, sections, difficulty)), s AS (SELECT query_id, unnest(string_split(sections, ',')) AS code FROM t)
SELECT query_id, CAST(count(*) AS BIGINT) AS expected FROM s JOIN x ON x.acronym = s.code GROUP BY query_id""")
def expected_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = Q._context(spark, sf).select("doc_id", "c.policy_acronym")
    return V.expected_by_section(V.test_queries(spark), docs).groupBy("query_id").agg(F.count("*").alias("expected"))


@_query("""SELECT * FROM (VALUES (1::BIGINT, 'openai', 'small', 0.5::DOUBLE), (1::BIGINT, 'openai', 'small', 0.75::DOUBLE), (2::BIGINT, 'cohere', 'english', 0.25::DOUBLE), (3::BIGINT, 'sentence', 'base', 0.125::DOUBLE)) AS v(embedding_model_id, provider, model_name, precision_at_5)""")
def save_evaluation(spark: SparkSession, sf: str) -> DataFrame:
    """Results saved beside a known model, twice, and beside models that are new."""
    models = spark.createDataFrame([(1, "openai", "small", 1536, 0.00002, True)], "id long, provider string, model_name string, dimension int, cost_per_1k double, is_active boolean")
    held = spark.createDataFrame([(1, 0.5)], "embedding_model_id long, precision_at_5 double")
    results = spark.createDataFrame(
        [("openai_small", "small", 1536, 0.00002, 0.75), ("sentence_transformers", "base", 768, 0.0, 0.125), ("cohere", "english", 1024, 0.0001, 0.25)],
        "provider_name string, model_name string, dimension int, cost_per_1k double, precision_at_5 double",
    )
    after, evaluations = V.save_evaluation(models, held, results)
    return evaluations.join(after.select(F.col("id").alias("embedding_model_id"), "provider", "model_name"), "embedding_model_id")


@_query(f"""WITH RECURSIVE {Q._cut_sql(Q._LOSSLESS)}, d AS (SELECT doc_id FROM (SELECT DISTINCT doc_id FROM k) ORDER BY doc_id LIMIT 100)
SELECT doc_id, chunk_index FROM k JOIN d USING (doc_id) WHERE chunk_index < 5""")
def evaluation_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Five chunks of each of the first hundred documents that have any."""
    chunks = Q._chunks(spark, sf, Q._LOSSLESS)
    docs = chunks.select("doc_id").distinct().orderBy("doc_id").limit(100)
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("chunk_index"))
    return chunks.join(F.broadcast(docs), "doc_id").withColumn("r", rank).where("r <= 5").select("doc_id", "chunk_index")


@_query(f"""WITH w AS (SELECT len({Q._WORDS.format("text")}) AS n FROM benchmark), a AS (SELECT CAST(count(*) AS BIGINT) AS embeddings, CAST(sum(floor(n * 0.75)) AS BIGINT) AS tokens, round(count(*) FILTER (n > 0) / count(*), 6) AS success_rate FROM w)
SELECT v.provider, v.dimension, embeddings, tokens, round(tokens / 1000.0 * price, 9)::DOUBLE AS cost, CAST(ceil(embeddings / size) AS BIGINT) AS batches, success_rate FROM a, (VALUES ('small', 16, 32, 0.00002::DOUBLE), ('large', 64, 7, 0.00013::DOUBLE)) AS v(provider, dimension, size, price)""")
def provider_comparison(spark: SparkSession, sf: str) -> DataFrame:
    made = {"small": (M.HashingEmbedder(16, "small"), 32, 0.00002), "large": (M.HashingEmbedder(64, "large"), 7, 0.00013)}
    found = M.compare(table(spark, sf, "benchmark").select("text"), "text", made)
    return found.withColumns({"cost": F.round("cost", 9), "success_rate": F.round("success_rate", 6)})


@_query("""WITH c AS (SELECT label, d, avg(x) AS x FROM (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS d FROM embeddings) GROUP BY label, d), k AS (SELECT label AS l, list(x ORDER BY d) AS c FROM c GROUP BY label),
f AS (SELECT vec_id, label, l, list_distance(CAST(embedding AS DOUBLE[]), c) AS f FROM embeddings, k), s AS (SELECT vec_id, max(f) FILTER (l = label) AS a, min(f) FILTER (l <> label) AS b FROM f GROUP BY vec_id)
SELECT round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM s""")
def centroid_silhouette(spark: SparkSession, sf: str) -> DataFrame:
    return V.centroid_silhouette(Q._vectors(spark, sf)).select(F.round("silhouette", 6).alias("silhouette"))
