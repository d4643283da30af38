"""The library's queries over the test tables, each with its SQL where SQL expresses it.

Inputs that the tables lack are derived from ids by expressions that Spark and DuckDB both read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom import config
from corpusloom.functions import cleaning as C
from corpusloom.functions import context as X
from corpusloom.functions import describe as D
from corpusloom.operators import chunking as K
from corpusloom.operators import embedding as M
from corpusloom.operators import evaluate as V
from corpusloom.operators import state as S
from corpusloom.operators import vectors as W
from corpusloom.plans import reports as R
from corpusloom.plans.registry import Registry
from corpusloom.session import table
from corpusloom.sources import documents as P
from corpusloom.streaming import files as L

_R = Registry()
_query, queries, oracle_sql = _R.query, _R.queries, _R.oracle_sql


# ---------------------------------------------------------------- inputs, in a dialect that both engines read

RAW = """concat(text, CASE doc_id % 12
 WHEN 0 THEN concat(chr(10), chr(10), 'Page 3 of 99', chr(10), '42', chr(10))
 WHEN 1 THEN concat(chr(10), 'See https://example.org/a?b=1 now', chr(10), '_____', chr(10), '----- end')
 WHEN 2 THEN concat(chr(10), '*This document is uncontrolled when printed.*', chr(10), 'Effective Date: 1/2/2020')
 WHEN 3 THEN concat(chr(10), 'Care Manual', chr(10), 'Same', chr(10), 'Same', chr(10), ' Same', chr(10), 'Same', chr(10), 'Last line')
 WHEN 4 THEN concat(chr(10), chr(10), chr(10), chr(10), 'A  b   c ', chr(9), 'd  ', chr(10), 'Printed on: 12/31/2024')
 WHEN 5 THEN concat(chr(10), '| a | b |', chr(10), '|---|---|', chr(10), '| 1 |  |', chr(10), '- item', chr(10))
 WHEN 6 THEN concat(chr(10), '# Head one', chr(10), 'Body. More', chr(10), '### Third', chr(10), 'END MATTER', chr(10), 'x')
 WHEN 7 THEN concat(chr(10), 'Introduction ..... 12', chr(10), 'Section 4: Scope', chr(10), 'Revision: 1.2')
 WHEN 8 THEN concat('. ', chr(10), chr(10), 'Next paragraph. And one.', chr(10), chr(10), 'Last')
 WHEN 9 THEN concat(chr(10), 'CARE1-P10.01 code', chr(10), 'Privacy matters', chr(10), 'ok')
 ELSE '' END)"""

MANUAL = """CASE doc_id % 10 WHEN 0 THEN 'Administration' WHEN 1 THEN 'Care' WHEN 2 THEN 'Emergency Planning and Management'
 WHEN 3 THEN 'Environmental Services' WHEN 4 THEN 'Infection Prevention and Control' WHEN 5 THEN 'Legal' WHEN 6 THEN 'Maintenance'
 WHEN 7 THEN 'Privacy and Confidentiality' WHEN 8 THEN 'RC' ELSE 'Loose Papers' END"""
PLACE = "CASE doc_id % 4 WHEN 0 THEN 'Additional Resources/' WHEN 1 THEN 'Medication Safety/' WHEN 2 THEN 'Section A/Part 1/' ELSE '' END"
NAME = """concat(CASE doc_id % 5 WHEN 0 THEN 'CARE1-P10.01 ' WHEN 1 THEN 'adm2-P05.02-T3 ' WHEN 2 THEN 'XYZ1-P10.01 ' ELSE '' END,
 CASE doc_id % 9 WHEN 0 THEN 'Policy_Manual' WHEN 1 THEN 'Resident Form Template' WHEN 2 THEN 'Training Guide' WHEN 3 THEN 'Process Flowchart'
 WHEN 4 THEN 'Quick Reference' WHEN 5 THEN 'Infection Checklist' WHEN 6 THEN 'Equipment-Log Format' WHEN 7 THEN 'Emergency Notice' ELSE 'Minutes' END,
 CASE doc_id % 3 WHEN 0 THEN '.pdf' WHEN 1 THEN '.DOCX' ELSE '.txt' END)"""
PATH = f"concat('/corpus/mirror/', {MANUAL}, '/', {PLACE}, {NAME})"
ROOT = "/corpus/mirror"

#: Files: orders as file states, and what a later listing finds of them.
STATE = """concat('f', CAST(o_orderkey AS STRING)) AS file_path, concat('h', CAST(o_custkey AS STRING)) AS file_hash,
 CASE o_orderkey % 6 WHEN 0 THEN 'pending' WHEN 1 THEN 'processing' WHEN 2 THEN 'error' WHEN 3 THEN 'deleted' ELSE 'synced' END AS sync_status,
 o_orderkey % 5 AS sync_error_count, o_orderdate AS updated_at,
 CASE o_orderkey % 4 WHEN 0 THEN concat('Failed to parse: part ', CAST(o_custkey % 7 AS STRING)) WHEN 1 THEN 'file is not a Word file' WHEN 2 THEN 'ValueError: not a textpage of this page' ELSE 'disk full' END AS last_error_message"""
LISTING = "concat('f', CAST(o_orderkey AS STRING)) AS file_path, concat('h', CAST(CASE WHEN o_orderkey % 11 = 0 THEN o_custkey + 1 ELSE o_custkey END AS STRING)) AS file_hash"
STATE_SQL = STATE.replace("AS STRING", "AS VARCHAR")
LISTING_SQL = LISTING.replace("AS STRING", "AS VARCHAR")
_S = f"s AS (SELECT {STATE_SQL} FROM orders)"
#: What a listing is compared with lacks every seventh file.
_SOME = f"s AS (SELECT {STATE_SQL} FROM orders WHERE o_orderkey % 7 <> 0)"
_L = f"l AS (SELECT {LISTING_SQL} FROM orders WHERE o_orderkey % 13 <> 0)"


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", "source", "lang", F.expr(RAW).alias("raw"))


def _context(spark: SparkSession, sf: str) -> DataFrame:
    paths = _docs(spark, sf).select("doc_id", "n_chars", F.expr(PATH).alias("path"))
    return paths.withColumn("c", X.context(F.col("path"), ROOT))


def _state(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").selectExpr(*_split(STATE))


def _some(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").where("o_orderkey % 7 <> 0").selectExpr(*_split(STATE))


def _listing(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").where("o_orderkey % 13 <> 0").selectExpr(*_split(LISTING))


def _split(columns: str) -> list[str]:
    """A select list as separate expressions."""
    out, depth, quoted, last = [], 0, False, 0
    for i, ch in enumerate(columns):
        quoted ^= ch == "'"
        depth += (ch == "(") - (ch == ")")
        if ch == "," and not depth and not quoted:
            out.append(columns[last:i])
            last = i + 1
    return [*out, columns[last:]]


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings")


# ---------------------------------------------------------------- cleaning


def _sql_chain(expr: str, patterns: list[str], options: str) -> str:
    for p in patterns:
        expr = f"regexp_replace({expr}, '{p}', '', '{options}')"
    return expr


_DISCLAIMED = _sql_chain(RAW, config.Organisation().disclaimers(), "gis")
_STRIP = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"
_NORMAL = "regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '[ \\t]+', ' ', 'g'), '\\n\\s*\\n\\s*\\n+', chr(10) || chr(10), 'g'), '(?m)[^\\S\\n]+$', '', 'g'), '^\\s+|\\s+$', '', 'g')"
_HEADER = "(?i)^(?:" + "|".join(f"(?:{p.removeprefix('^').removesuffix('$')})" for p in config.HEADER_PATTERNS) + ")"


def _sql_headers(text: str) -> str:
    """CTEs d(doc_id, source, raw, t) and h(doc_id, t2): header and footer lines filtered out of ``text``."""
    return f"""d AS (SELECT doc_id, source, {RAW} AS raw, {text} AS t FROM documents),
ln AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS n FROM d),
st AS (SELECT doc_id, n, line, {_STRIP.format("line")} AS s FROM ln),
ct AS (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS k FROM st),
h AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (s = '' OR (k <= 3 AND NOT regexp_matches(s, '{_HEADER}'))), '') AS t2 FROM ct GROUP BY doc_id)"""


_CLEANED = f"""{_sql_headers(_DISCLAIMED)},
c AS (SELECT d.doc_id, source, raw, {_NORMAL.format(_sql_chain("t2", [f"(?m){p}" for p in config.NOISE_PATTERNS], "g"))} AS cleaned FROM d JOIN h USING (doc_id))"""


@_query(f"""WITH {_CLEANED}
SELECT source, CAST(count(*) AS BIGINT) AS documents, CAST(sum(length(raw)) AS BIGINT) AS original, CAST(sum(length(cleaned)) AS BIGINT) AS cleaned,
 round(avg((length(raw) - length(cleaned)) / greatest(length(raw), 1)), 6) AS reduction, CAST(count(*) FILTER (length(cleaned) < 0.3 * length(raw)) AS BIGINT) AS excessive FROM c GROUP BY source""")
def clean_stats_by_source(spark: SparkSession, sf: str) -> DataFrame:
    rows = _raw(spark, sf).withColumn("cleaned", C.clean(F.col("raw"))).withColumn("s", C.cleaning_stats(F.col("raw"), F.col("cleaned")))
    return rows.groupBy("source").agg(
        F.count("*").alias("documents"),
        F.sum("s.original_length").alias("original"),
        F.sum("s.cleaned_length").alias("cleaned"),
        F.round(F.avg("s.reduction_ratio"), 6).alias("reduction"),
        F.count_if("s.excessive").alias("excessive"),
    )


@_query(f"SELECT doc_id, sha256({_DISCLAIMED}) AS digest FROM documents")
def clean_disclaimers(spark: SparkSession, sf: str) -> DataFrame:
    return _raw(spark, sf).select("doc_id", F.sha2(C.remove_disclaimers(F.col("raw")), 256).alias("digest"))


@_query(f"WITH {_sql_headers(RAW)} SELECT doc_id, sha256(t2) AS digest FROM h")
def clean_headers_footers(spark: SparkSession, sf: str) -> DataFrame:
    return _raw(spark, sf).select("doc_id", F.sha2(C.remove_headers_footers(F.col("raw")), 256).alias("digest"))


@_query(f"SELECT doc_id, sha256({_sql_chain(RAW, [f'(?m){p}' for p in config.NOISE_PATTERNS], 'g')}) AS digest FROM documents")
def clean_noise(spark: SparkSession, sf: str) -> DataFrame:
    return _raw(spark, sf).select("doc_id", F.sha2(C.remove_noise(F.col("raw")), 256).alias("digest"))


@_query(f"SELECT doc_id, sha256({_NORMAL.format(RAW)}) AS digest FROM documents")
def normalize_whitespace(spark: SparkSession, sf: str) -> DataFrame:
    return _raw(spark, sf).select("doc_id", F.sha2(C.normalize_whitespace(F.col("raw")), 256).alias("digest"))


@_query(f"WITH {_CLEANED} SELECT doc_id, length(cleaned) AS n, sha256(cleaned) AS digest FROM c")
def clean_full(spark: SparkSession, sf: str) -> DataFrame:
    rows = _raw(spark, sf).select("doc_id", C.clean(F.col("raw")).alias("cleaned"))
    return rows.select("doc_id", F.char_length("cleaned").cast("long").alias("n"), F.sha2("cleaned", 256).alias("digest"))


@_query(
    "SELECT doc_id, sha256("
    + _STRIP.format(f"regexp_replace(regexp_replace(regexp_replace({RAW}, '{config.Organisation().fast()}', '', 'gis'), '\\n\\s*\\n\\s*\\n+', chr(10) || chr(10), 'g'), '[ \\t]+', ' ', 'g')")
    + ") AS digest FROM documents"
)
def clean_fast(spark: SparkSession, sf: str) -> DataFrame:
    return _raw(spark, sf).select("doc_id", F.sha2(C.clean_fast(F.col("raw")), 256).alias("digest"))


_WORDS = "list_filter(regexp_split_to_array({0}, '\\s+'), lambda w: w <> '')"


@_query(f"""WITH {_CLEANED}, w AS (SELECT doc_id, raw, cleaned, len({_WORDS.format("raw")}) AS a, len({_WORDS.format("cleaned")}) AS b FROM c)
SELECT doc_id, CASE WHEN raw = '' THEN 'valid' WHEN b / greatest(a, 1) < 0.3 THEN 'word_loss' WHEN length(cleaned) / length(raw) < 0.2 THEN 'char_loss' WHEN b < 10 THEN 'too_short' ELSE 'valid' END AS verdict FROM w""")
def validate_cleaning(spark: SparkSession, sf: str) -> DataFrame:
    rows = _raw(spark, sf).withColumn("cleaned", C.clean(F.col("raw")))
    return rows.select("doc_id", C.validate_cleaning(F.col("raw"), F.col("cleaned")).alias("verdict"))


@_query(
    "SELECT 'noise' AS kind, p AS pattern, CAST(sum(c) AS BIGINT) AS removed FROM ("
    + " UNION ALL ".join(
        f"SELECT {i} AS p, len(regexp_extract_all({_sql_chain(RAW, [f'(?m){q}' for q in config.NOISE_PATTERNS[:i]], 'g')}, '(?m){p}')) AS c FROM documents" for i, p in enumerate(config.NOISE_PATTERNS)
    )
    + ") WHERE c > 0 GROUP BY p"
)
def patterns_removed(spark: SparkSession, sf: str) -> DataFrame:
    rows = _raw(spark, sf).select(F.explode(C.pattern_counts(F.col("raw"), config.NOISE_PATTERNS, "noise", "m")).alias("s"))
    return rows.groupBy("s.kind", "s.pattern").agg(F.sum("s.count").alias("removed"))


@_query(f"""WITH l AS (SELECT doc_id, {_STRIP.format(f"unnest(string_split({RAW}, chr(10)))")} AS line FROM documents)
SELECT doc_id, line, CAST(count(*) AS BIGINT) AS n FROM l WHERE line <> '' GROUP BY doc_id, line HAVING count(*) > 3""")
def repeated_lines(spark: SparkSession, sf: str) -> DataFrame:
    lines = _raw(spark, sf).select("doc_id", F.explode(F.split("raw", "\n", -1)).alias("line")).withColumn("line", C.strip(F.col("line"))).where("line <> ''")
    return lines.groupBy("doc_id", "line").agg(F.count("*").alias("n")).where("n > 3")


def _ngram_sql(having: str) -> str:
    return f"""WITH w AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents WHERE doc_id >= 0),
g AS (SELECT doc_id, unnest(flatten([list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i : i + n - 1], ' ')) for n in [2, 3, 4, 5]])) AS phrase FROM w)
SELECT phrase, CAST(count(*) AS BIGINT) AS occurrences, CAST(count(DISTINCT doc_id) AS BIGINT) AS documents FROM g WHERE length(phrase) BETWEEN 10 AND 100 GROUP BY phrase {having}"""


def _numbered(spark: SparkSession, sf: str) -> DataFrame:
    """The documents whose phrases are counted."""
    return _docs(spark, sf).where("doc_id >= 0")


@_query(f"SELECT occurrences, CAST(count(*) AS BIGINT) AS phrases, CAST(sum(documents) AS BIGINT) AS documents, CAST(sum(length(phrase)) AS BIGINT) AS characters FROM ({_ngram_sql('')}) GROUP BY occurrences")
def ngram_frequency(spark: SparkSession, sf: str) -> DataFrame:
    """All phrases, by how often they occur."""
    return C.phrase_histogram(_numbered(spark, sf), F.col("text"), "doc_id")


@_query(f"SELECT * FROM ({_ngram_sql('')}) WHERE documents >= floor((SELECT count(*) FROM documents) * 0.02)")
def frequent_noise(spark: SparkSession, sf: str) -> DataFrame:
    return C.phrase_counts(_numbered(spark, sf), F.col("text"), "doc_id", least_documents=_docs(spark, sf).count() * 2 // 100)


# ---------------------------------------------------------------- context and descriptions

_ACRONYM = "CASE m " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in config.MANUALS.items()) + " END"
_TYPE = "CASE " + " ".join(f"WHEN regexp_matches(lower(file_name), '{'|'.join(p)}') THEN '{k}'" for k, p in X.TYPE_PATTERNS.items()) + " END"
_INDEX = "(?i)^((?:" + "|".join(sorted(config.MANUALS.values())) + ")\\d*-[A-Z]\\d+\\.\\d+(?:-[A-Z]\\d+)?)"
_CTX = f"""p AS (SELECT doc_id, n_chars, {PATH} AS path FROM documents),
q AS (SELECT doc_id, n_chars, path, substr(path, {len(ROOT) + 2}) AS rel, string_split(substr(path, {len(ROOT) + 2}), '/') AS parts FROM p),
r AS (SELECT *, parts[1] AS m, parts[2] AS section, parts[3] AS subsection, parts[len(parts)] AS file_name FROM q),
x AS (SELECT *, {_ACRONYM} AS acronym, nullif(upper(regexp_extract(file_name, '{_INDEX}', 1)), '') AS idx, {_TYPE} AS kind,
 coalesce(contains(lower(section), 'additional') AND contains(lower(section), 'resource'), false) AS additional FROM r)"""


@_query(f"""WITH {_CTX} SELECT doc_id, rel AS relative_path, file_name, m AS policy_manual, acronym AS policy_acronym, section, subsection, idx AS document_index,
 additional AS is_additional_resource, kind AS document_type, array_to_string(parts[1 : len(parts) - 1], '>') AS hierarchy FROM x""")
def path_context(spark: SparkSession, sf: str) -> DataFrame:
    return _context(spark, sf).select("doc_id", "c.*").withColumn("hierarchy", F.array_join("hierarchy_path", ">")).drop("hierarchy_path")


@_query(f"WITH {_CTX} SELECT doc_id, idx AS document_index FROM x WHERE idx IS NOT NULL")
def document_index(spark: SparkSession, sf: str) -> DataFrame:
    return _context(spark, sf).select("doc_id", "c.document_index").where("document_index IS NOT NULL")


@_query(f"WITH {_CTX} SELECT kind AS document_type, CAST(count(*) AS BIGINT) AS n FROM x GROUP BY kind")
def document_type(spark: SparkSession, sf: str) -> DataFrame:
    return _context(spark, sf).groupBy("c.document_type").agg(F.count("*").alias("n"))


@_query(f"""WITH {_CTX}, n AS (SELECT doc_id, acronym, additional, row_number() OVER (PARTITION BY coalesce(acronym, 'UNK'), additional ORDER BY path, doc_id) AS k FROM x)
SELECT doc_id, printf('%s-%s-%03d', coalesce(acronym, 'UNK'), CASE WHEN additional THEN 'ADDL' ELSE 'MISC' END, k) AS synthetic_index FROM n""")
def synthetic_index(spark: SparkSession, sf: str) -> DataFrame:
    rows = _context(spark, sf).select("doc_id", "path", "c.policy_acronym", "c.is_additional_resource")
    w = Window.partitionBy(F.coalesce("policy_acronym", F.lit("UNK")), "is_additional_resource").orderBy("path", "doc_id")
    return rows.select("doc_id", X.synthetic_index(F.col("policy_acronym"), F.col("is_additional_resource"), F.row_number().over(w)).alias("synthetic_index"))


_TAGS = """array_to_string(list_sort(list_distinct(list_filter([replace(lower(m), ' ', '_'), lower(acronym), replace(lower(section), ' ', '_'), kind,
 CASE WHEN additional THEN 'additional_resource' END, CASE WHEN idx IS NULL THEN 'non_indexed_document' ELSE 'indexed_document' END, 'index_' || lower(idx),
 CASE WHEN contains(lower(file_name), 'form') THEN 'form' END, CASE WHEN contains(lower(file_name), 'checklist') THEN 'checklist' END,
 CASE WHEN contains(lower(file_name), 'template') THEN 'template' END, CASE WHEN contains(lower(file_name), 'guide') THEN 'guide' END,
 CASE WHEN contains(lower(file_name), 'flowchart') OR contains(lower(file_name), 'flow chart') THEN 'flowchart' END], lambda t: t IS NOT NULL))), ',')"""


@_query(f"WITH {_CTX} SELECT doc_id, {_TAGS} AS tags FROM x")
def context_tags(spark: SparkSession, sf: str) -> DataFrame:
    return _context(spark, sf).select("doc_id", F.array_join(X.tags(F.col("c")), ",").alias("tags"))


@_query(f"""WITH {_CTX} SELECT doc_id, coalesce(m, '') <> '' AS is_valid, CAST((CASE WHEN acronym IS NULL THEN 1 ELSE 0 END) + (CASE WHEN idx IS NULL AND NOT additional THEN 1 ELSE 0 END)
 + (CASE WHEN len(parts) - 1 < 2 THEN 1 ELSE 0 END) AS INTEGER) AS warnings FROM x""")
def context_validate(spark: SparkSession, sf: str) -> DataFrame:
    return _context(spark, sf).withColumn("v", X.validate(F.col("c"))).select("doc_id", "v.is_valid", F.size("v.warnings").alias("warnings"))


@_query(f"""WITH {_CTX} SELECT doc_id, ((m IS NOT NULL)::INT + (acronym IS NOT NULL)::INT + (section IS NOT NULL)::INT + (subsection IS NOT NULL)::INT + (idx IS NOT NULL)::INT
 + (kind IS NOT NULL)::INT + (len(parts) > 1)::INT + 1) / 8.0::DOUBLE AS completeness FROM x""")
def context_completeness(spark: SparkSession, sf: str) -> DataFrame:
    return _context(spark, sf).select("doc_id", X.completeness(F.col("c")).alias("completeness"))


@_query(f"WITH {_CTX} SELECT doc_id, coalesce(string_split(path, '/')[4], 'Unknown') AS policy, coalesce(string_split(path, '/')[5], 'Root') AS section FROM x")
def folder_after_marker(spark: SparkSession, sf: str) -> DataFrame:
    return _context(spark, sf).select("doc_id", X.folders_after(F.col("path"), "mirror").alias("f")).select("doc_id", "f.*")


_FORM = """CASE WHEN regexp_matches(lower(file_name), 'checklist|check.*list') THEN 'checklist' WHEN regexp_matches(lower(file_name), 'template') THEN 'template'
 WHEN regexp_matches(replace(lower(file_name), 'format', ''), 'form') OR regexp_matches(lower(file_name), 'sheet|log|record') THEN 'form' WHEN regexp_matches(lower(file_name), 'audit|assessment|evaluation') THEN 'audit'
 WHEN regexp_matches(lower(file_name), 'inventory|utilization|tracking') THEN 'inventory' WHEN regexp_matches(lower(file_name), 'poster|sign|notice') THEN 'poster' ELSE 'form' END"""
_TITLE = "coalesce(nullif(lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(file_name, '\\.[^.]*$', ''), '^[A-Z]+\\d*-[A-Z]\\d+\\.\\d+(?:-[A-Z]\\d+)?\\s*', ''), '[_-]+', ' ', 'g'), '\\s+', ' ', 'g'))), ''), 'document')"


def _sql_purposes() -> str:
    found = [f"CASE WHEN contains(lower(file_name), '{w}') THEN '{p}' END" for p, words in D.PURPOSES.items() for w in words]
    cols = {"policy_manual": "m", "section": "section", "file_name": "file_name"}
    found += ["CASE " + " ".join(f"WHEN contains(lower({cols[f]}), '{w}') THEN '{p}'" for w, p in pairs) + " END" for f, pairs in D.ADDED.items()]
    return f"list_filter([{', '.join(found)}], lambda u: u IS NOT NULL)"


_PURPOSE = "CASE WHEN len(u) = 0 THEN 'organizational procedures' WHEN len(u) = 2 THEN u[1] || ' and ' || u[2] ELSE u[1] END"
_FORMS = f"{_CTX}, y AS (SELECT *, {_FORM} AS form, {_TITLE} AS title, {_sql_purposes()} AS u FROM x), z AS (SELECT *, {_PURPOSE} AS purpose FROM y)"


@_query(f"WITH {_FORMS} SELECT doc_id, form AS form_type FROM z")
def form_type(spark: SparkSession, sf: str) -> DataFrame:
    return _context(spark, sf).select("doc_id", D.form_type(F.col("c.file_name")).alias("form_type"))


@_query(f"WITH {_FORMS} SELECT doc_id, title FROM z")
def form_title(spark: SparkSession, sf: str) -> DataFrame:
    return _context(spark, sf).select("doc_id", D.form_title(F.col("c.file_name")).alias("title"))


@_query(f"WITH {_FORMS} SELECT doc_id, purpose FROM z")
def form_purpose(spark: SparkSession, sf: str) -> DataFrame:
    return _context(spark, sf).select("doc_id", D.form_purpose(F.col("c")).alias("purpose"))


def _sql_list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_KEYS = "CASE form " + " ".join(f"WHEN '{k}' THEN {_sql_list(t[2])}" for k, t in D.TYPES.items()) + " END"
_USES = "CASE form " + " ".join(f"WHEN '{k}' THEN {_sql_list(t[3])}" for k, t in D.TYPES.items()) + " END"
_MORE = "list_filter([" + ", ".join(f"CASE WHEN contains(purpose, '{w}') THEN '{u}' END" for w, u in D.ADDED_USES) + "], lambda t: t IS NOT NULL)"
_KEYWORDS = f"""array_to_string(list_sort(list_distinct(list_filter(list_concat({_KEYS}, list_filter([lower(acronym), lower(idx)], lambda t: t IS NOT NULL), string_split(lower(m), ' '),
 string_split(purpose, ' '), coalesce(string_split(lower(section), ' '), [])), lambda t: length(t) > 2))), ' ')"""
_USECASES = f"array_to_string(list_sort(list_distinct(list_concat({_USES}, {_MORE}))), ',')"


@_query(f"WITH {_FORMS} SELECT doc_id, {_KEYWORDS} AS keywords FROM z")
def form_keywords(spark: SparkSession, sf: str) -> DataFrame:
    return _context(spark, sf).select("doc_id", F.array_join(D.keywords(F.col("c")), " ").alias("keywords"))


@_query(f"WITH {_FORMS} SELECT doc_id, {_USECASES} AS use_cases FROM z")
def form_use_cases(spark: SparkSession, sf: str) -> DataFrame:
    return _context(spark, sf).select("doc_id", F.array_join(D.use_cases(F.col("c")), ",").alias("use_cases"))


@_query(f"""WITH {_FORMS} SELECT doc_id, round(least(1.0, 0.5 + 0.1 + (section IS NOT NULL)::INT * 0.1 + (idx IS NOT NULL)::INT * 0.1 + regexp_matches(lower(file_name), 'checklist|template|form')::INT * 0.15
 + CASE WHEN n_chars * 100 > 10000 AND n_chars * 100 < 500000 THEN 0.1 WHEN n_chars * 100 > 500000 THEN 0.05 ELSE 0 END)::DOUBLE, 6) AS confidence FROM z""")
def form_confidence(spark: SparkSession, sf: str) -> DataFrame:
    return _context(spark, sf).select("doc_id", F.round(D.confidence(F.col("c"), F.col("n_chars") * 100), 6).alias("confidence"))


def _sql_template() -> str:
    cases = []
    for k, t in D.TYPES.items():
        body = "'" + t[1].replace("{title}", "' || title || '").replace("{purpose}", "' || purpose || '").replace("{manual}", "' || m || '") + "'"
        cases.append(f"WHEN '{k}' THEN {body}")
    return "CASE form " + " ".join(cases) + " END"


@_query(f"""WITH {_FORMS} SELECT doc_id, concat({_sql_template()}, coalesce(' This document is used within the ' || section || ' section.', ''), coalesce(' Document reference: ' || idx || '.', '')) AS description FROM z""")
def synthetic_description(spark: SparkSession, sf: str) -> DataFrame:
    return _context(spark, sf).select("doc_id", D.description(F.col("c")).alias("description"))


# ---------------------------------------------------------------- chunking

_CUTS = K.Cuts(size=100, overlap=15, minimum=25, lossless=False, fallback="chars")
_LOSSLESS = K.Cuts(size=100, overlap=15, minimum=25, lossless=True, fallback="chars")


def _ends_sql(pattern: str) -> str:
    return f"""(SELECT doc_id, CAST(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY n) AS INTEGER) AS pos FROM
 (SELECT doc_id, unnest(ps) AS piece, generate_subscripts(ps, 1) AS n FROM (SELECT doc_id, regexp_extract_all(raw, '(?s).*?{pattern}') AS ps FROM t)))"""


_LINES = f"""t AS (SELECT doc_id, {RAW} AS raw FROM documents),
l0 AS (SELECT doc_id, unnest(string_split(raw, chr(10))) AS line, generate_subscripts(string_split(raw, chr(10)), 1) AS n FROM t),
l AS (SELECT *, CAST(coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS start FROM l0)"""
_TABLES = """tm AS (SELECT *, regexp_matches(line, '^\\s*\\|.*\\|\\s*$') AS r FROM l), tg AS (SELECT *, sum(CASE WHEN r THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY n) AS run FROM tm),
tz AS (SELECT doc_id, run, min(start) AS start, max(start + length(line)) AS fin, list(line ORDER BY n) AS ls FROM tg WHERE r GROUP BY doc_id, run),
tb AS (SELECT doc_id, start, CAST(fin AS INTEGER) AS fin FROM tz WHERE regexp_matches(ls[2], '^\\s*\\|[\\s:|-]*-[\\s:|-]*\\|\\s*$'))"""
_SECTIONS = """hb AS (SELECT doc_id, start, CAST(length(regexp_extract(line, '^(#+)', 1)) AS INTEGER) AS level FROM l WHERE regexp_matches(line, '^#{1,6}\\s+.+$'))"""
_BOUNDS = f"""{_LINES}, {_TABLES}, {_SECTIONS},
sb AS {_ends_sql("[.!?]\\s+")}, pb AS {_ends_sql("\\n\\s*\\n")},
bd AS (SELECT doc_id, pos, max(pri) AS pri FROM (SELECT doc_id, pos, 1 AS pri FROM sb UNION ALL SELECT doc_id, pos, 3 FROM pb UNION ALL SELECT doc_id, start, 10 - level FROM hb
 UNION ALL SELECT doc_id, start, 8 FROM tb UNION ALL SELECT doc_id, fin, 8 FROM tb) GROUP BY doc_id, pos)"""


def _cut_sql(how: K.Cuts) -> str:
    """CTEs up to k(doc_id, chunk_index, chunk_text, char_start, char_end): the cut loop as a recursion."""
    size, adv, low, lap = 4 * how.size, max(100, 2 * how.size), 4 * how.minimum, 4 * how.overlap
    end = f"""(SELECT CASE WHEN e - p < {low} THEN least(p + {low}, n) ELSE e END FROM (SELECT least(n, coalesce((SELECT b.pos FROM bd b WHERE b.doc_id = w.doc_id
 AND b.pos BETWEEN p + {size // 2} AND p + {size + size // 2} ORDER BY -b.pri, abs(b.pos - p - {size}), b.pos LIMIT 1), p + {size})) AS e))"""
    tail = f"UNION ALL SELECT doc_id, e, n, n FROM last WHERE e < n" if how.lossless else ""  # noqa: F541
    return f"""{_BOUNDS},
w0 AS (SELECT doc_id, 0 AS p, length(raw) AS n FROM t WHERE length(raw) > 0),
cuts AS (SELECT doc_id, p, n, {end} AS e FROM w0 w
 UNION ALL SELECT doc_id, p, n, {end} AS e FROM (SELECT doc_id, greatest(e - {lap}, p + {adv}) AS p, n FROM cuts WHERE greatest(e - {lap}, p + {adv}) < n - {adv}) w),
last AS (SELECT doc_id, max_by(e, p) AS e, any_value(n) AS n FROM cuts GROUP BY doc_id),
every AS (SELECT doc_id, p, n, e FROM cuts {tail}),
bodies AS (SELECT doc_id, p, e, n, {_STRIP.format("substr(raw, p + 1, e - p)")} AS body FROM every JOIN t USING (doc_id)),
k AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY p) - 1 AS INTEGER) AS chunk_index, body AS chunk_text, CAST(p AS INTEGER) AS char_start, CAST(e AS INTEGER) AS char_end, p / n AS position
 FROM bodies WHERE body <> '')"""


def _chunks(spark: SparkSession, sf: str, how: K.Cuts) -> DataFrame:
    return K.chunk(_raw(spark, sf), "doc_id", "raw", how)


_TOKENS = "len(regexp_extract_all({0}, '[\\p{{L}}\\p{{N}}\\p{{M}}_]+|[^\\p{{L}}\\p{{N}}\\p{{M}}_\\s]'))"


@_query(f"SELECT doc_id, CAST({_TOKENS.format('text')} AS INTEGER) AS tokens FROM documents")
def token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", K.token_count(F.col("text")).alias("tokens"))


@_query(f"WITH {_BOUNDS} SELECT doc_id, pos FROM sb")
def sentence_boundaries(spark: SparkSession, sf: str) -> DataFrame:
    return _raw(spark, sf).select("doc_id", F.explode(K.sentence_boundaries(F.col("raw"))).alias("pos"))


@_query(f"WITH {_BOUNDS} SELECT doc_id, pos FROM pb")
def paragraph_boundaries(spark: SparkSession, sf: str) -> DataFrame:
    return _raw(spark, sf).select("doc_id", F.explode(K.paragraph_boundaries(F.col("raw"))).alias("pos"))


@_query(f"WITH {_LINES}, {_SECTIONS} SELECT doc_id, start AS position, level, CAST(10 - level AS INTEGER) AS priority FROM hb")
def section_boundaries(spark: SparkSession, sf: str) -> DataFrame:
    return K.section_boundaries(_raw(spark, sf), "doc_id", "raw")


@_query(f'WITH {_LINES}, {_TABLES} SELECT doc_id, start, fin AS "end" FROM tb')
def table_boundaries(spark: SparkSession, sf: str) -> DataFrame:
    return K.table_boundaries(_raw(spark, sf), "doc_id", "raw")


@_query("SELECT doc_id, sha256(text)[1:16] AS chunk_hash FROM documents")
def chunk_hash(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", K.chunk_hash(F.col("text")).alias("chunk_hash"))


@_query(f"""WITH t AS (SELECT doc_id, {RAW} AS raw FROM documents)
SELECT doc_id, contains(raw, '|') AND contains(raw, '-') AS has_table, regexp_matches(raw, '(?m)^\\s*[-*+]\\s') AS has_list, regexp_matches(raw, '(?m)^#{{1,6}}\\s') AS has_heading FROM t""")
def structure_flags(spark: SparkSession, sf: str) -> DataFrame:
    return _raw(spark, sf).select("doc_id", K.structure_flags(F.col("raw")).alias("f")).select("doc_id", "f.*")


@_query(f"""WITH {_LINES}, c AS (SELECT doc_id, n, {_STRIP.format("line")} AS s FROM l),
k AS (SELECT doc_id, s, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC) AS r FROM c WHERE upper(s) = s AND lower(s) <> s AND length(s) < 100)
SELECT doc_id, max(s) FILTER (r = 2) AS section, max(s) FILTER (r = 1) AS subsection FROM k GROUP BY doc_id""")
def section_titles(spark: SparkSession, sf: str) -> DataFrame:
    rows = _raw(spark, sf).select("doc_id", K.section_titles(F.col("raw"), F.char_length("raw")).alias("s"))
    return rows.select("doc_id", "s.*").where("subsection IS NOT NULL")


@_query(f"WITH RECURSIVE {_cut_sql(_CUTS)} SELECT doc_id, chunk_index, sha256(chunk_text) AS digest, char_start, char_end, round(position, 6) AS position FROM k")
def chunk_fixed_reference(spark: SparkSession, sf: str) -> DataFrame:
    k = _chunks(spark, sf, _CUTS)
    return k.select("doc_id", "chunk_index", F.sha2("chunk_text", 256).alias("digest"), "char_start", "char_end", F.round("position", 6).alias("position"))


@_query(f"WITH RECURSIVE {_cut_sql(_LOSSLESS)} SELECT doc_id, chunk_index, sha256(chunk_text) AS digest, char_start, char_end, round(position, 6) AS position FROM k")
def chunk_lossless(spark: SparkSession, sf: str) -> DataFrame:
    k = _chunks(spark, sf, _LOSSLESS)
    return k.select("doc_id", "chunk_index", F.sha2("chunk_text", 256).alias("digest"), "char_start", "char_end", F.round("position", 6).alias("position"))


@_query(f"""WITH c AS (SELECT conv_id, turn, {_WORDS.format("lag(text) OVER w")} AS b, {_WORDS.format("lead(text) OVER w")} AS a FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text))
SELECT conv_id, turn, nullif(concat_ws(' | ', CASE WHEN len(b) > 0 THEN '...' || array_to_string(b[greatest(len(b) - 49, 1) :], ' ') END, CASE WHEN len(a) > 0 THEN array_to_string(a[1:50], ' ') || '...' END), '') AS context FROM c""")
def surrounding_context(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").withColumn("__order", F.struct("turn", "role", "text"))
    return K.surrounding_context(turns, "conv_id", "__order", "text").select("conv_id", "turn", "context")


@_query(f"""WITH RECURSIVE {_cut_sql(_CUTS)}, cs AS (SELECT doc_id, char_start AS c FROM k UNION SELECT doc_id, char_end FROM k),
b AS (SELECT bd.doc_id, bd.pos, max(CASE WHEN abs(c - bd.pos) < 20 THEN 1 ELSE 0 END) AS ok FROM bd JOIN cs USING (doc_id) GROUP BY bd.doc_id, bd.pos)
SELECT doc_id, round(coalesce(avg(ok), 1.0), 6) AS preservation FROM (SELECT DISTINCT doc_id FROM cs) LEFT JOIN b USING (doc_id) GROUP BY doc_id""")
def boundary_preservation(spark: SparkSession, sf: str) -> DataFrame:
    cuts = _chunks(spark, sf, _CUTS).groupBy("doc_id").agg(F.array_union(F.collect_set("char_start"), F.collect_set("char_end")).alias("cuts"))
    bounds = K.boundaries(_raw(spark, sf), "doc_id", "raw")
    return cuts.join(bounds, "doc_id").select("doc_id", F.round(K.preservation(F.col("cuts"), F.col("bounds")), 6).alias("preservation"))


@_query(f"""WITH RECURSIVE {_cut_sql(_LOSSLESS)}, n AS (SELECT doc_id, {_TOKENS.format("chunk_text")} AS tk FROM k)
SELECT doc_id, CAST(count(*) AS BIGINT) AS total_chunks, CAST(sum(tk) AS BIGINT) AS total_tokens, round(avg(tk), 4) AS avg_tokens, 0.15::DOUBLE AS overlap_ratio FROM n GROUP BY doc_id""")
def chunk_stats(spark: SparkSession, sf: str) -> DataFrame:
    by = K.document_stats(_chunks(spark, sf, _LOSSLESS), "doc_id", K.token_count(F.col("chunk_text")).cast("long"), _LOSSLESS)
    return by.withColumn("avg_tokens", F.round("avg_tokens", 4))


_VALID = f"""{_cut_sql(_LOSSLESS)}, n AS (SELECT doc_id, {_TOKENS.format("chunk_text")} AS tk FROM k),
cs AS (SELECT doc_id, char_start AS c FROM k UNION SELECT doc_id, char_end FROM k),
b AS (SELECT bd.doc_id, bd.pos, max(CASE WHEN abs(c - bd.pos) < 20 THEN 1 ELSE 0 END) AS ok FROM bd JOIN cs USING (doc_id) GROUP BY bd.doc_id, bd.pos),
pr AS (SELECT doc_id, avg(ok) AS kept FROM b GROUP BY doc_id),
q AS (SELECT doc_id, count(*) AS chunks, count(*) FILTER (tk < 25) AS small, count(*) FILTER (tk > 150) AS large, avg(tk) AS m, stddev_pop(tk) AS d FROM n GROUP BY doc_id),
va AS (SELECT q.*, coalesce(kept, 1.0) AS kept, (small > 0)::INT + (large > 0)::INT AS issues FROM q LEFT JOIN pr USING (doc_id)),
vb AS (SELECT *, greatest(0, least(1, 1 - 0.1 * issues + 0.2 * kept - CASE WHEN m > 0 AND d / m > 0.5 THEN 0.2 ELSE 0 END))::DOUBLE AS quality FROM va)"""


def _validated(spark: SparkSession, sf: str) -> DataFrame:
    return K.validation(_chunks(spark, sf, _LOSSLESS), K.boundaries(_raw(spark, sf), "doc_id", "raw"), "doc_id", 25, 150)


def _six(value: Column) -> Column:
    """Six digits as DuckDB rounds: halves of the product, which may lie beside those of the decimal number."""
    return F.round(value * 1e6, 0) / 1e6


@_query(f"WITH RECURSIVE {_VALID} SELECT doc_id, CAST(issues AS INTEGER) AS issues, round(kept, 6) AS preservation, round(quality, 6) AS quality FROM vb")
def chunk_quality(spark: SparkSession, sf: str) -> DataFrame:
    v = _validated(spark, sf)
    return v.select("doc_id", F.size("issues").alias("issues"), _six(F.col("preservation")).alias("preservation"), _six(F.col("quality_score")).alias("quality"))


@_query(f"""WITH RECURSIVE {_VALID} SELECT CAST(count(*) AS BIGINT) AS documents, round(avg(quality), 6) AS avg_quality, round(avg(chunks), 6) AS avg_chunks, round(avg(m), 6) AS avg_chunk_size,
 round(avg(kept), 6) AS avg_preservation FROM vb""")
def chunk_validation(spark: SparkSession, sf: str) -> DataFrame:
    m = K.validation_means(_validated(spark, sf))
    return m.select(*[F.round(c, 6).alias(c) if c != "documents" else F.col(c) for c in m.columns])


@_query(f"""WITH RECURSIVE {_VALID}, i AS (SELECT small || ' chunks below minimum size' AS issue FROM vb WHERE small > 0 UNION ALL SELECT large || ' chunks above maximum size' FROM vb WHERE large > 0)
SELECT issue, CAST(count(*) AS BIGINT) AS n FROM i GROUP BY issue ORDER BY n DESC, issue LIMIT 5""")
def chunk_issues(spark: SparkSession, sf: str) -> DataFrame:
    return K.common_issues(_validated(spark, sf))


@_query()
def tune_chunking(spark: SparkSession, sf: str) -> DataFrame:
    return K.best_cuts(K.tune(_raw(spark, sf), [100, 200], [15, 30], "doc_id", "raw"))


# ---------------------------------------------------------------- vectors

_Q = "(SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 7)"
_COS = f"list_cosine_similarity(CAST(embedding AS DOUBLE[]), {_Q})"


def _found(rows: DataFrame) -> DataFrame:
    return rows.select("vec_id", "label", F.round("score", 6).alias("score"))


def _seventh(spark: SparkSession, sf: str) -> list[float]:
    return W.vector_of(_vectors(spark, sf), 7)


@_query(f"SELECT vec_id, label, round({_COS}, 6) AS score FROM embeddings ORDER BY {_COS} DESC, vec_id LIMIT 10")
def vector_topk_cosine(spark: SparkSession, sf: str) -> DataFrame:
    return _found(W.search(_vectors(spark, sf), _seventh(spark, sf)))


@_query(f"SELECT vec_id, label, round(list_dot_product(CAST(embedding AS DOUBLE[]), {_Q}), 6) AS score FROM embeddings ORDER BY list_dot_product(CAST(embedding AS DOUBLE[]), {_Q}) DESC, vec_id LIMIT 10")
def vector_topk_dot(spark: SparkSession, sf: str) -> DataFrame:
    return _found(W.search(_vectors(spark, sf), _seventh(spark, sf), metric="dot"))


@_query(f"SELECT vec_id, label, round(list_distance(CAST(embedding AS DOUBLE[]), {_Q}), 6) AS score FROM embeddings ORDER BY list_distance(CAST(embedding AS DOUBLE[]), {_Q}), vec_id LIMIT 10")
def vector_topk_euclidean(spark: SparkSession, sf: str) -> DataFrame:
    return _found(W.search(_vectors(spark, sf), _seventh(spark, sf), metric="euclidean"))


@_query(f"SELECT vec_id, label, round({_COS}, 6) AS score FROM embeddings WHERE label = 3 ORDER BY {_COS} DESC, vec_id LIMIT 10")
def vector_filtered_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _found(W.search(_vectors(spark, sf), _seventh(spark, sf), where=W.matches({"label": 3})))


@_query(f"SELECT vec_id, label, round({_COS}, 6) AS score FROM embeddings WHERE {_COS} >= 0.2")
def vector_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return _found(W.search(_vectors(spark, sf), _seventh(spark, sf), limit=None, threshold=0.2))


@_query(f"SELECT vec_id, label, round({_COS}, 6) AS score FROM embeddings WHERE label IN (1, 2) ORDER BY {_COS} DESC, vec_id LIMIT 10")
def vector_filter_any(spark: SparkSession, sf: str) -> DataFrame:
    return _found(W.search(_vectors(spark, sf), _seventh(spark, sf), where=W.matches({"label": [1, 2]})))


@_query("SELECT vec_id, label, 0.0::DOUBLE AS score FROM embeddings WHERE label = 1 AND label = 2")
def vector_filter_all(spark: SparkSession, sf: str) -> DataFrame:
    return _found(W.search(_vectors(spark, sf), _seventh(spark, sf), where=W.matches({"label": [1, 2]}, "all")))


@_query(f"SELECT vec_id, label, round({_COS}, 6) AS score FROM embeddings WHERE vec_id <> 7 ORDER BY {_COS} DESC, vec_id LIMIT 5")
def similar_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return _found(W.similar(_vectors(spark, sf), 7))


_BATCH = """q AS (SELECT vec_id AS query_id, label AS ql, CAST(embedding AS DOUBLE[]) AS qv FROM embeddings WHERE vec_id % 20 = 0),
s AS (SELECT query_id, ql, vec_id, label, list_cosine_similarity(CAST(embedding AS DOUBLE[]), qv) AS score FROM embeddings, q),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s QUALIFY rank <= 20)"""


def _ranked(spark: SparkSession, sf: str) -> DataFrame:
    v = _vectors(spark, sf)
    return W.batch_search(v, v.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding"))


@_query(f"WITH {_BATCH} SELECT query_id, vec_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM r")
def batch_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(spark, sf).select("query_id", "vec_id", F.round("score", 6).alias("score"), "rank")


@_query("SELECT CAST(count(*) AS BIGINT) AS total_vectors, CAST(max(len(embedding)) AS INTEGER) AS dimension FROM embeddings")
def collection_stats(spark: SparkSession, sf: str) -> DataFrame:
    return W.collection_stats(_vectors(spark, sf))


_NEW = "SELECT vec_id + 100 AS vec_id, embedding, label + 1 AS label FROM embeddings WHERE vec_id % 3 = 0"


@_query(f"WITH n AS ({_NEW}), u AS (SELECT vec_id, label FROM n UNION ALL SELECT vec_id, label FROM embeddings WHERE vec_id NOT IN (SELECT vec_id FROM n)) SELECT label, CAST(count(*) AS BIGINT) AS n, CAST(sum(vec_id) AS BIGINT) AS ids FROM u GROUP BY label")
def upsert_vectors(spark: SparkSession, sf: str) -> DataFrame:
    v = _vectors(spark, sf)
    new = v.where("vec_id % 3 = 0").select((F.col("vec_id") + 100).alias("vec_id"), "embedding", (F.col("label") + 1).alias("label"))
    return W.upsert(v, new).groupBy("label").agg(F.count("*").alias("n"), F.sum("vec_id").alias("ids"))


@_query("SELECT label, CAST(count(*) AS BIGINT) AS n FROM embeddings WHERE vec_id % 4 <> 0 GROUP BY label")
def delete_vectors(spark: SparkSession, sf: str) -> DataFrame:
    v = _vectors(spark, sf)
    return W.delete(v, v.where("vec_id % 4 = 0")).groupBy("label").agg(F.count("*").alias("n"))


@_query("SELECT vec_id, CASE WHEN vec_id % 5 = 0 THEN label + 10 ELSE label END AS label, CASE WHEN vec_id % 5 = 0 THEN 'seen' END AS note FROM embeddings")
def payload_merge(spark: SparkSession, sf: str) -> DataFrame:
    v = _vectors(spark, sf)
    changes = v.where("vec_id % 5 = 0").select("vec_id", (F.col("label") + 10).alias("label"), F.lit("seen").alias("note"))
    return W.merge_payload(v, changes).select("vec_id", "label", "note")


# ---------------------------------------------------------------- evaluation

_METRICS = f"""{_BATCH}, e AS (SELECT q.query_id, count(*) AS n FROM q JOIN embeddings v ON v.label = q.ql GROUP BY q.query_id),
m AS (SELECT r.query_id, q_label.n, count(*) FILTER (rank <= 5 AND label = ql) / count(*) FILTER (rank <= 5) AS p, count(*) FILTER (rank <= 10 AND label = ql) / any_value(q_label.n) AS rc,
 coalesce(1.0 / min(rank) FILTER (label = ql), 0) AS rr FROM r JOIN e q_label USING (query_id) GROUP BY r.query_id, q_label.n)"""


def _metrics(spark: SparkSession, sf: str) -> DataFrame:
    v = _vectors(spark, sf)
    wanted = v.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("label").alias("ql"))
    sizes = v.groupBy(F.col("label").alias("ql")).agg(F.count("*").alias("n_expected"))
    expected = wanted.join(sizes, "ql")
    ranked = _ranked(spark, sf).join(v.select("vec_id", "label"), "vec_id").join(wanted, "query_id").withColumn("hit", F.col("label") == F.col("ql"))
    return V.retrieval_metrics(ranked, expected.select("query_id", "n_expected")).join(expected.select("query_id", "n_expected"), "query_id")


@_query(f"WITH {_METRICS} SELECT query_id, round(p, 6) AS precision, round(rc, 6) AS recall, round(rr, 6) AS reciprocal_rank FROM m")
def retrieval_by_query(spark: SparkSession, sf: str) -> DataFrame:
    return _metrics(spark, sf).select("query_id", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "reciprocal_rank")])


@_query(f"WITH {_METRICS} SELECT round(avg(p), 6) AS precision_at_5, round(avg(rc), 6) AS recall_at_10, round(avg(rr), 6) AS mrr FROM m")
def retrieval_means(spark: SparkSession, sf: str) -> DataFrame:
    return _metrics(spark, sf).agg(F.round(F.avg("precision"), 6).alias("precision_at_5"), F.round(F.avg("recall"), 6).alias("recall_at_10"), F.round(F.avg("reciprocal_rank"), 6).alias("mrr"))


@_query(f"WITH {_METRICS} SELECT round(avg(p), 6) AS cross_precision, round(avg(rc), 6) AS cross_recall FROM m WHERE n >= 2")
def cross_document(spark: SparkSession, sf: str) -> DataFrame:
    return _metrics(spark, sf).where("n_expected >= 2").agg(F.round(F.avg("precision"), 6).alias("cross_precision"), F.round(F.avg("recall"), 6).alias("cross_recall"))


_PAIRS = "SELECT a.vec_id AS i, a.label AS la, b.label AS lb, list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS c, list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS d FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id"


@_query(f"WITH p AS ({_PAIRS}), g AS (SELECT la, avg(c) AS m FROM p WHERE la = lb GROUP BY la) SELECT round(avg(m), 6) AS intra_similarity, CAST(count(*) AS BIGINT) AS groups FROM g")
def intra_cluster(spark: SparkSession, sf: str) -> DataFrame:
    return V.intra_cluster(_vectors(spark, sf)).select(F.round("intra_similarity", 6).alias("intra_similarity"), "groups")


@_query(f"WITH p AS ({_PAIRS}), g AS (SELECT la, lb, avg(c) AS m FROM p WHERE la < lb GROUP BY la, lb) SELECT round(1 - avg(m), 6) AS inter_separation FROM g")
def inter_cluster(spark: SparkSession, sf: str) -> DataFrame:
    return V.inter_cluster(_vectors(spark, sf)).select(F.round("inter_separation", 6).alias("inter_separation"))


@_query(f"""WITH p AS ({_PAIRS}), g AS (SELECT i, la, lb, avg(d) AS m FROM p GROUP BY i, la, lb), s AS (SELECT i, max(m) FILTER (la = lb) AS a, min(m) FILTER (la <> lb) AS b FROM g GROUP BY i)
SELECT round(avg(CASE WHEN a IS NULL OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM s""")
def silhouette(spark: SparkSession, sf: str) -> DataFrame:
    return V.silhouette(_vectors(spark, sf)).select(F.round("silhouette", 6).alias("silhouette"))


@_query("SELECT label, CAST(count(*) AS BIGINT) AS n FROM embeddings GROUP BY label")
def group_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return _vectors(spark, sf).groupBy("label").agg(F.count("*").alias("n"))


@_query(f"""WITH {_METRICS}, a AS (SELECT avg(p) AS p, avg(rc) AS r, avg(rr) AS x, avg(p) FILTER (n >= 2) AS cp, avg(rc) FILTER (n >= 2) AS cr FROM m), pairs AS ({_PAIRS}),
g AS (SELECT la, lb, avg(c) AS m FROM pairs GROUP BY la, lb), k AS (SELECT avg(m) FILTER (la = lb) AS intra, 1 - avg(m) FILTER (la < lb) AS inter FROM g),
d AS (SELECT i, la, lb, avg(d) AS m FROM pairs GROUP BY i, la, lb), t AS (SELECT i, max(m) FILTER (la = lb) AS a, min(m) FILTER (la <> lb) AS b FROM d GROUP BY i),
u AS (SELECT avg(CASE WHEN a IS NULL OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END) AS sil FROM t),
z AS (SELECT *, least(1, greatest(0, .4 * p + .3 * r + .3 * x)) AS rq, least(1, greatest(0, .4 * (sil + 1) / 2 + .3 * intra + .3 * inter)) AS sq FROM a, k, u)
SELECT round(rq, 6) AS retrieval_quality, round(sq, 6) AS semantic_quality, round(least(1, greatest(0, .5 * rq + .3 * sq + .2 * (cp + cr) / 2)), 6) AS overall_quality FROM z""")
def quality_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Quality with every part measured; cross-document queries are those that expect several rows."""
    v, cross = _vectors(spark, sf), F.col("n_expected") >= 2
    m = _metrics(spark, sf).agg(*[F.avg(F.when(only, F.col(c))).alias(n) for n, c, only in (("p", "precision", F.lit(True)), ("r", "recall", F.lit(True)), ("x", "reciprocal_rank", F.lit(True)), ("cp", "precision", cross), ("cr", "recall", cross))])
    rows = m.crossJoin(V.silhouette(v)).crossJoin(V.intra_cluster(v)).crossJoin(V.inter_cluster(v))
    parts = [F.col(c) for c in ("p", "r", "x", "silhouette", "intra_similarity", "inter_separation", "cp", "cr")]
    q = rows.select(V.quality_scores(*parts).alias("q")).select("q.*")
    return q.select(*[F.round(c, 6).alias(c) for c in q.columns])


@_query("SELECT (d * 200 + q * 10) * 0.75::DOUBLE AS tokens, round((d * 200 + q * 10) * 0.75 / 1000 * 0.00002, 9)::DOUBLE AS total_cost, round((d * 200 + q * 10) * 0.75 / 1000 * 0.00002 / q, 9)::DOUBLE AS cost_per_query FROM (SELECT (SELECT count(*) FROM documents) AS d, (SELECT count(*) FROM benchmark) AS q)")
def cost_model(spark: SparkSession, sf: str) -> DataFrame:
    d = _docs(spark, sf).agg(F.count("*").alias("d")).join(table(spark, sf, "benchmark").agg(F.count("*").alias("q")))
    c = d.select(V.cost(F.col("d"), F.col("q"), F.lit(0.00002)).alias("c")).select("c.*")
    return c.select("tokens", F.round("total_cost", 9).alias("total_cost"), F.round("cost_per_query", 9).alias("cost_per_query"))


@_query("SELECT * FROM (VALUES ('sentence_transformers', 768, 32, 0.0::DOUBLE), ('openai_small', 1536, 2048, 0.00002::DOUBLE), ('openai_large', 3072, 2048, 0.00013::DOUBLE), ('cohere', 1024, 96, 0.0001::DOUBLE)) AS v(provider, dimension, batch_size, cost_per_1k)")
def provider_registry(spark: SparkSession, sf: str) -> DataFrame:
    return M.registry(spark)


_SOME_BLANK = "CASE WHEN doc_id % 211 = 0 THEN ' ' ELSE text END"


@_query(f"""WITH w AS (SELECT len({_WORDS.format(_SOME_BLANK)}) AS n, (row_number() OVER (ORDER BY doc_id) - 1) // 96 AS b FROM documents), k AS (SELECT b, count(*) AS c, sum(floor(n * 0.75)) AS t, min((n > 0)::INT) AS ok FROM w GROUP BY b)
SELECT CAST(sum(c) AS BIGINT) AS embeddings, CAST(sum(t) AS BIGINT) AS tokens, round(sum(t) / 1000 * 0.0001, 6)::DOUBLE AS cost, CAST(count(*) AS BIGINT) AS batches, round(sum(ok) / count(*), 6) AS success_rate FROM k""")
def embedding_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of embedding; a batch with a text without words fails."""
    b = M.batches(_docs(spark, sf).select("doc_id", F.expr(_SOME_BLANK).alias("text")), "doc_id", "text", 96, 0.0001)
    return b.select("embeddings", "tokens", F.round("cost", 6).alias("cost"), "batches", F.round("success_rate", 6).alias("success_rate"))


@_query("""WITH r AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents WHERE n_chars > 0) SELECT source, doc_id, CAST(k AS INTEGER) AS k FROM r WHERE k <= 5""")
def evaluation_sample(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("source").orderBy("doc_id")
    return _docs(spark, sf).where("n_chars > 0").select("source", "doc_id", F.row_number().over(w).alias("k")).where("k <= 5")


@_query()
def retrieval_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """Documents cleaned, chunked and embedded; the five best chunks for each benchmark item."""
    embedder = M.HashingEmbedder()
    chunks = K.chunk(_docs(spark, sf).select("doc_id", C.clean(F.col("text")).alias("text")))
    stored = M.embed(W.chunk_payload(chunks, embedder.name), "text", embedder)
    wanted = M.embed(table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text"), "text", embedder).select("query_id", "embedding")
    return W.batch_search(stored.select("vector_id", "embedding"), wanted, 5, key="vector_id").select("query_id", "vector_id", F.round("score", 6).alias("score"), "rank")


# ---------------------------------------------------------------- state


@_query(f"""WITH {_SOME}, {_L}, j AS (SELECT coalesce(l.file_path, s.file_path) AS file_path, CASE WHEN s.file_path IS NULL THEN 'new' WHEN l.file_path IS NULL THEN CASE WHEN s.sync_status <> 'deleted' THEN 'deleted' END
 WHEN s.sync_status = 'deleted' THEN 'restored' WHEN l.file_hash IS DISTINCT FROM s.file_hash THEN 'modified' ELSE 'unchanged' END AS change FROM l FULL JOIN s ON l.file_path = s.file_path)
SELECT file_path, change FROM j WHERE change IS NOT NULL""")
def scan_diff(spark: SparkSession, sf: str) -> DataFrame:
    return S.scan_diff(_listing(spark, sf), _some(spark, sf))


@_query(f"WITH {_SOME}, {_L} SELECT * FROM l WHERE file_path NOT IN (SELECT file_path FROM s)")
def new_files(spark: SparkSession, sf: str) -> DataFrame:
    return S.new_files(_listing(spark, sf), _some(spark, sf))


@_query(f"WITH {_SOME}, {_L} SELECT file_path, sync_status FROM s WHERE sync_status <> 'deleted' AND file_path NOT IN (SELECT file_path FROM l)")
def deleted_files(spark: SparkSession, sf: str) -> DataFrame:
    return S.deleted_files(_some(spark, sf), _listing(spark, sf)).select("file_path", "sync_status")


@_query(f"WITH {_S} SELECT file_path, sync_status FROM s WHERE sync_status = 'pending' ORDER BY file_path LIMIT 50")
def pending_files(spark: SparkSession, sf: str) -> DataFrame:
    return S.pending(_state(spark, sf), 50).select("file_path", "sync_status")


@_query(f"WITH {_S} SELECT file_path, sync_error_count FROM s WHERE sync_status = 'error' AND sync_error_count < 3")
def retry_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return S.retry_candidates(_state(spark, sf)).select("file_path", "sync_error_count")


@_query(f"WITH {_S} SELECT file_path FROM s WHERE sync_status = 'processing' AND updated_at < TIMESTAMP '1996-01-01 00:00:00' - INTERVAL 30 MINUTE")
def stuck_files(spark: SparkSession, sf: str) -> DataFrame:
    return S.stuck_files(_state(spark, sf), F.expr("timestamp_ntz '1996-01-01 00:00:00'")).select("file_path")


@_query(f"WITH {_S} SELECT CASE WHEN sync_status <> 'synced' THEN 'pending' ELSE sync_status END AS sync_status, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY 1")
def requeue(spark: SparkSession, sf: str) -> DataFrame:
    return R.status_counts(S.requeue(_state(spark, sf)))


@_query(f"WITH {_S} SELECT CASE WHEN sync_status = 'error' AND sync_error_count < 3 THEN 'pending' ELSE sync_status END AS sync_status, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY 1")
def retry_failed(spark: SparkSession, sf: str) -> DataFrame:
    return R.status_counts(S.retry(_state(spark, sf)))


@_query(f"WITH {_S}, {_L} SELECT CASE WHEN file_path IN (SELECT file_path FROM l) THEN 'processing' ELSE sync_status END AS sync_status, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY 1")
def mark_processing(spark: SparkSession, sf: str) -> DataFrame:
    return R.status_counts(S.mark(_state(spark, sf), _listing(spark, sf), "processing"))


@_query(f"""WITH o AS (SELECT file_path, file_hash, sync_error_count AS id FROM (SELECT {STATE_SQL} FROM orders WHERE o_orderkey % 7 <> 0)), {_L}
SELECT coalesce(o.file_path, l.file_path) AS file_path, coalesce(o.id, 99) AS id, coalesce(l.file_hash, o.file_hash) AS file_hash FROM o FULL JOIN l ON o.file_path = l.file_path""")
def upsert_documents(spark: SparkSession, sf: str) -> DataFrame:
    old = _some(spark, sf).select("file_path", F.col("sync_error_count").alias("id"), "file_hash")
    return S.upsert_documents(old, _listing(spark, sf).withColumn("id", F.lit(99).cast("long")))


@_query("""WITH f AS (SELECT o_orderkey FROM orders WHERE o_orderkey % 6 = 3) SELECT (SELECT CAST(count(*) AS BIGINT) FROM orders) - (SELECT CAST(count(*) AS BIGINT) FROM f) AS files,
 (SELECT CAST(count(*) AS BIGINT) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM f)) AS chunks""")
def cascade_delete(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    files = orders.select(F.col("o_orderkey").alias("file_path"), F.when(F.expr("o_orderkey % 6 = 3"), "deleted").otherwise("synced").alias("sync_status"))
    docs = orders.select(F.col("o_orderkey").alias("file_path"), F.col("o_orderkey").alias("document_id"))
    left, _, chunks = S.cascade_delete(files, docs, table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("document_id"), "l_linenumber"))
    return left.agg(F.count("*").alias("files")).join(chunks.agg(F.count("*").alias("chunks")))


_KIND = """CASE WHEN event_id % 7 = 0 THEN 'deleted' WHEN event_type = 'signup' THEN 'created' WHEN event_type = 'view' THEN 'started' WHEN event_type = 'purchase' THEN 'succeeded'
 WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'click' THEN CASE WHEN event_id % 2 = 0 THEN 'modified' ELSE 'created' END END"""
_HASH = "CASE WHEN event_type IN ('signup', 'click') THEN concat('h', event_id % 3) END"


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "ts", F.col("user_id").cast("string").alias("file_path"), F.expr(_KIND).alias("kind"), F.expr(_HASH).alias("file_hash"))


@_query(f"""WITH RECURSIVE e AS (SELECT CAST(user_id AS VARCHAR) AS file_path, {_KIND} AS kind, {_HASH} AS digest, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
f AS (SELECT DISTINCT file_path, 0::BIGINT AS n, NULL::VARCHAR AS st, 0::BIGINT AS errs, NULL::VARCHAR AS h FROM e
 UNION ALL SELECT file_path, n, CASE WHEN eff THEN new ELSE st END, CASE WHEN eff AND new = 'error' THEN errs + 1 WHEN eff AND new = 'synced' THEN 0 ELSE errs END, CASE WHEN eff THEN coalesce(digest, h) ELSE h END
 FROM (SELECT f.file_path, e.n, f.st, f.errs, f.h, e.digest, CASE e.kind WHEN 'started' THEN 'processing' WHEN 'succeeded' THEN 'synced' WHEN 'failed' THEN 'error' WHEN 'deleted' THEN 'deleted' ELSE 'pending' END AS new,
  CASE WHEN e.kind IS NULL THEN false WHEN e.kind = 'created' THEN f.st IS NULL OR f.st = 'deleted' WHEN e.kind = 'deleted' THEN f.st IS NOT NULL
   WHEN e.kind = 'modified' THEN f.st IS NULL OR e.digest IS NULL OR e.digest IS DISTINCT FROM f.h ELSE true END AS eff
  FROM f JOIN e ON e.file_path = f.file_path AND e.n = f.n + 1))
SELECT file_path, st AS sync_status, errs AS sync_error_count FROM f WHERE st IS NOT NULL AND (file_path, n) IN (SELECT file_path, max(n) FROM e GROUP BY file_path)""")
def state_machine(spark: SparkSession, sf: str) -> DataFrame:
    return S.latest_status(_events(spark, sf))


@_query("""WITH m AS (SELECT CAST(o_orderkey AS VARCHAR) AS a, 'x' || o_orderkey AS b, CASE o_orderkey % 3 WHEN 0 THEN 'moved' WHEN 1 THEN 'created' ELSE 'deleted' END AS k FROM orders)
SELECT a AS file_path, CASE WHEN k = 'moved' THEN 'deleted' ELSE k END AS kind FROM m UNION ALL SELECT b, 'moved' FROM m WHERE k = 'moved'""")
def moved_files(spark: SparkSession, sf: str) -> DataFrame:
    m = table(spark, sf, "orders").selectExpr("CAST(o_orderkey AS STRING) AS file_path", "concat('x', o_orderkey) AS dest_path", "CASE o_orderkey % 3 WHEN 0 THEN 'moved' WHEN 1 THEN 'created' ELSE 'deleted' END AS kind")
    return S.split_moves(m).select("file_path", "kind")


# ---------------------------------------------------------------- reports


@_query(f"WITH {_S} SELECT sync_status, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY 1")
def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return R.status_counts(_state(spark, sf))


_COUNTS = ", ".join(f"CAST(count(*) FILTER (sync_status = '{k}') AS BIGINT) AS {k}" for k in R.STATUSES)


@_query(f"WITH {_S} SELECT {_COUNTS}, CAST(count(*) FILTER (sync_status <> 'deleted') AS BIGINT) AS total, round(100.0 * count(*) FILTER (sync_status = 'synced') / count(*) FILTER (sync_status <> 'deleted'), 6)::DOUBLE AS percent FROM s")
def progress(spark: SparkSession, sf: str) -> DataFrame:
    return R.progress(_state(spark, sf)).withColumn("percent", F.round("percent", 6))


@_query(f"WITH {_S} SELECT {_COUNTS}, CAST(count(*) AS BIGINT) AS total, max(updated_at) AS last_scan FROM s")
def monitor_status(spark: SparkSession, sf: str) -> DataFrame:
    s = _state(spark, sf)
    return R.progress(s, count_deleted=True).drop("percent").join(s.agg(F.max("updated_at").alias("last_scan")))


@_query(f"WITH {_S} SELECT sync_status, CAST(count(*) AS BIGINT) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6)::DOUBLE AS percent FROM s GROUP BY 1")
def status_share(spark: SparkSession, sf: str) -> DataFrame:
    return R.status_share(_state(spark, sf)).withColumn("percent", F.round("percent", 6))


@_query(f"""WITH {_S}, p AS (SELECT CASE WHEN contains(last_error_message, ':') THEN split_part(last_error_message, ':', 1) ELSE 'Unknown' END AS prefix, file_path AS k FROM s WHERE sync_status = 'error')
SELECT prefix, CAST(count(*) AS BIGINT) AS n, array_to_string(list(k ORDER BY k)[1:3], ',') AS examples, CAST(greatest(count(*) - 3, 0) AS BIGINT) AS more FROM p GROUP BY prefix""")
def error_prefix_groups(spark: SparkSession, sf: str) -> DataFrame:
    return R.error_groups(_state(spark, sf).where("sync_status = 'error'"), "last_error_message", "file_path")


_CLASS = "CASE " + " ".join(f"WHEN contains(last_error_message, '{t}') THEN '{n}'" for n, t in R.ERROR_CLASSES) + " ELSE 'Other Error' END"
_SUFFIX = "CASE sync_error_count WHEN 0 THEN 'pdf' WHEN 1 THEN 'doc' ELSE 'docx' END"


@_query(f"WITH {_S} SELECT {_CLASS} AS category, CAST(count(*) AS BIGINT) AS n, string_agg(DISTINCT {_SUFFIX}, ',' ORDER BY {_SUFFIX}) AS suffixes FROM s WHERE sync_status = 'error' GROUP BY 1")
def error_categories(spark: SparkSession, sf: str) -> DataFrame:
    return R.error_categories(_state(spark, sf).where("sync_status = 'error'"), "last_error_message", F.expr(_SUFFIX))


@_query(f"WITH {_S} SELECT round(100.0 * (count(*) - count(*) FILTER (sync_status = 'error')) / count(*), 6)::DOUBLE AS success_rate FROM s")
def success_rate(spark: SparkSession, sf: str) -> DataFrame:
    return _state(spark, sf).agg(F.round(R.success_rate(F.count_if(F.col("sync_status") == "error"), F.count("*")), 6).alias("success_rate"))


_PER_ORDER = "SELECT l_orderkey, count(*) AS total_chunks, CAST(sum(l_quantity) AS BIGINT) AS total_tokens FROM lineitem GROUP BY l_orderkey"


def _per_order(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("total_chunks"), F.sum("l_quantity").cast("long").alias("total_tokens"))


@_query(f"SELECT CAST(sum(total_chunks) AS BIGINT) AS chunks, CAST(sum(total_tokens) AS BIGINT) AS tokens, round(avg(total_chunks), 6) AS avg_chunks, CAST(min(total_chunks) AS BIGINT) AS min_chunks, CAST(max(total_chunks) AS BIGINT) AS max_chunks, round(avg(total_tokens), 6) AS avg_tokens FROM ({_PER_ORDER})")
def chunk_agg_stats(spark: SparkSession, sf: str) -> DataFrame:
    return R.chunk_totals(_per_order(spark, sf)).withColumns({c: F.round(c, 6) for c in ("avg_chunks", "avg_tokens")})


@_query(f"WITH p AS ({_PER_ORDER}) SELECT o_orderpriority AS policy, CAST(count(*) AS BIGINT) AS documents, CAST(sum(total_chunks) AS BIGINT) AS chunks, round(avg(total_chunks), 6) AS avg_chunks FROM p JOIN orders ON l_orderkey = o_orderkey GROUP BY 1")
def policy_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    rows = _per_order(spark, sf).join(table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("policy")), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.groupBy("policy").agg(F.count("*").alias("documents"), F.sum("total_chunks").alias("chunks"), F.round(F.avg("total_chunks"), 6).alias("avg_chunks"))


@_query("SELECT json_extract_string(props, '$.k') AS k, CAST(count(*) AS BIGINT) AS n, round(sum(value), 4) AS total, round(avg(value), 6) AS mean FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL GROUP BY 1")
def json_field_group(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select(F.get_json_object("props", "$.k").alias("k"), "value").where("k IS NOT NULL")
    return e.groupBy("k").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"), F.round(F.avg("value"), 6).alias("mean"))


@_query("SELECT lower(split_part(f, '.', 2)) AS file_type, CAST(count(*) AS BIGINT) AS n FROM (SELECT 'a.' || CASE doc_id % 3 WHEN 0 THEN 'PDF' WHEN 1 THEN 'docx' ELSE 'doc' END AS f FROM documents) GROUP BY 1")
def filetype_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    f = _docs(spark, sf).select(F.expr("concat('a.', CASE doc_id % 3 WHEN 0 THEN 'PDF' WHEN 1 THEN 'docx' ELSE 'doc' END)").alias("f"))
    return f.groupBy(F.substring(X.extension(F.col("f")), 2, 9).alias("file_type")).agg(F.count("*").alias("n"))


@_query("SELECT event_id, event_type, ts FROM events WHERE event_type = 'purchase' ORDER BY ts DESC, event_id DESC LIMIT 10")
def recent_ops(spark: SparkSession, sf: str) -> DataFrame:
    return R.recent(table(spark, sf, "events").where("event_type = 'purchase'"), "ts", "event_id", 10).select("event_id", "event_type", "ts")


@_query("SELECT event_id, user_id, c_name FROM (SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 10) e JOIN customer ON user_id = c_custkey")
def recent_ops_with_docs(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", "user_id", "ts")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_name")
    return R.recent_with(e, c, "user_id", "ts", "event_id", 10).select("event_id", "user_id", "c_name")


@_query("""WITH d AS (SELECT event_type, date_trunc('day', ts) AS day, count(*) AS n FROM events GROUP BY 1, 2), c AS (SELECT event_type, day, CAST(sum(n) OVER (PARTITION BY event_type ORDER BY day) AS BIGINT) AS done FROM d)
SELECT event_type, done, round(coalesce((done - lag(done, 4) OVER w) / (epoch(day - lag(day, 4) OVER w) / 60), 0), 6)::DOUBLE AS rate FROM c WINDOW w AS (PARTITION BY event_type ORDER BY day)""")
def throughput_eta(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "events").groupBy("event_type", F.date_trunc("day", F.col("ts").cast("timestamp")).alias("day")).agg(F.count("*").alias("n"))
    c = d.withColumn("done", F.sum("n").over(Window.partitionBy("event_type").orderBy("day")))
    return R.throughput(c, "done", "day", F.col("event_type")).select("event_type", "done", F.round("rate", 6).alias("rate"))


@_query("SELECT round(avg(value) FILTER (event_type = 'purchase'), 6) AS avg_ms, CAST(count(*) FILTER (event_type = 'purchase') AS BIGINT) AS added, CAST(count(*) FILTER (event_type = 'error') AS BIGINT) AS failed FROM events")
def operations_summary(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").selectExpr("CASE event_type WHEN 'purchase' THEN 'add' ELSE 'other' END AS kind", "CASE event_type WHEN 'error' THEN 'failed' ELSE 'success' END AS status", "value")
    return R.operations_summary(e, "kind", "status", "value").withColumn("avg_ms", F.round("avg_ms", 6))


@_query(f"""WITH w AS (SELECT len({_WORDS.format("text")}) AS n, n_chars // 1000 + 1 AS pages, n_chars >= 10 AS ok FROM documents) SELECT CAST(count(*) FILTER (ok) AS BIGINT) AS succeeded, CAST(count(*) FILTER (NOT ok) AS BIGINT) AS failed,
 CAST(sum(n) FILTER (ok) AS BIGINT) AS words, CAST(sum(n) FILTER (ok) // count(*) FILTER (ok) AS BIGINT) AS avg_words, CAST(sum(pages) FILTER (ok) AS BIGINT) AS pages, CAST(sum(pages) FILTER (ok) // count(*) FILTER (ok) AS BIGINT) AS avg_pages FROM w""")
def batch_summary(spark: SparkSession, sf: str) -> DataFrame:
    d = _docs(spark, sf).select(F.size(C.split_words(F.col("text"))).cast("long").alias("words"), F.expr("n_chars div 1000 + 1").alias("pages"), F.expr("n_chars >= 10").alias("ok"))
    return R.batch_summary(d, "ok", "words", "pages")


@_query("SELECT doc_id FROM labels WHERE quality = 0 ORDER BY doc_id LIMIT 10")
def invalid_examples(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels").where("quality = 0").orderBy("doc_id").limit(10).select("doc_id")


@_query("SELECT CAST(count(*) FILTER (quality = 1) AS BIGINT) AS valid, CAST(count(*) FILTER (quality = 0) AS BIGINT) AS invalid, round(100.0 * count(*) FILTER (quality = 1) / count(*), 6)::DOUBLE AS success_rate FROM labels")
def validation_summary(spark: SparkSession, sf: str) -> DataFrame:
    bad = F.count_if(F.col("quality") == 0)
    return table(spark, sf, "labels").agg(F.count_if(F.col("quality") == 1).alias("valid"), bad.alias("invalid"), F.round(R.success_rate(bad, F.count("*")), 6).alias("success_rate"))


@_query("SELECT doc_id, CASE WHEN doc_id < 60 THEN doc_id || 's' WHEN doc_id < 3600 THEN (doc_id // 60) || 'm' ELSE (doc_id // 3600) || 'h' END AS age, CASE WHEN length(text) > 40 THEN substr(text, 1, 37) || '...' ELSE text END AS title FROM documents")
def display_fields(spark: SparkSession, sf: str) -> DataFrame:
    return _docs(spark, sf).select("doc_id", R.age(F.col("doc_id")).alias("age"), R.shorten(F.col("text")).alias("title"))


# ---------------------------------------------------------------- sources and streams


_HTML = """trim(regexp_replace(regexp_replace(regexp_replace({0}, '[ \\t\\r]+', ' ', 'g'), ' ?\\n[ \\n]*', chr(10), 'g'), '^\\n+|\\n+$', '', 'g'), ' ')"""


def _html_sql() -> str:
    t = "regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', ' ', 'g')"
    t = f"regexp_replace({t}, '(?i)<br\\s*/?>|</p>|</div>|</h[1-6]>|</li>|</tr>', chr(10), 'g')"
    t = f"regexp_replace({t}, '<[^>]*>', ' ', 'g')"
    for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        t = f"replace({t}, '{a}', '{b}')"
    return _HTML.format(t)


@_query(f"SELECT page_id, sha256({_html_sql()}) AS digest FROM pages")
def html_to_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", F.sha2(P.html_to_text(F.col("html")), 256).alias("digest"))


@_query("SELECT n_nationkey, '| name' || repeat(' ', greatest(length(n_name), 4) - 4) || ' | key |' || chr(10) || '| ' || repeat('-', greatest(length(n_name), 4)) || ' | --- |' || chr(10) || '| ' || rpad(n_name, CAST(greatest(length(n_name), 4) AS INTEGER), ' ') || ' | ' || rpad(CAST(n_nationkey AS VARCHAR), 3, ' ') || ' |' || chr(10) || chr(10) AS md FROM nation")
def table_to_markdown(spark: SparkSession, sf: str) -> DataFrame:
    rows = F.array(F.array(F.lit("name"), F.lit("key")), F.array(F.col("n_name"), F.col("n_nationkey").cast("string")))
    return table(spark, sf, "nation").select("n_nationkey", P.table_to_markdown(rows).alias("md"))


@_query("SELECT n_nationkey, '**' || n_name || '**' || ' of ' || CASE WHEN n_regionkey = 1 THEN '***one***' ELSE '*other*' END AS md FROM nation")
def paragraph_markdown(spark: SparkSession, sf: str) -> DataFrame:
    run = lambda t, b, i: F.struct(t.alias("text"), b.alias("bold"), i.alias("italic"))
    yes, no, one = F.lit(True), F.lit(False), F.col("n_regionkey") == 1
    runs = F.array(run(F.col("n_name"), yes, no), run(F.lit(" of "), no, no), run(F.when(one, "one").otherwise("other"), one, yes))
    return table(spark, sf, "nation").select("n_nationkey", P.paragraph_markdown(runs).alias("md"))


@_query(f"""WITH t AS (SELECT doc_id, text, {RAW} AS raw, {_WORDS.format("lower(text)")} AS w FROM documents)
SELECT doc_id, CAST(len(w) AS INTEGER) AS word_count, len(w) >= 10 AND length(text) >= 50 AND length(text) / greatest(length(raw), 1) > 0.3 AND len(list_distinct(w)) / greatest(len(w), 1) > 0.1 AS good FROM t""")
def parse_quality(spark: SparkSession, sf: str) -> DataFrame:
    rows = _docs(spark, sf).select("doc_id", P.parse_quality(F.col("text"), F.expr(RAW)).alias("q"))
    return rows.select("doc_id", "q.word_count", "q.good")


@_query()
def scan_files(spark: SparkSession, sf: str) -> DataFrame:
    """The table files themselves, listed and hashed, whatever their size."""
    return P.hashed_files(spark, sf, (".parquet",)).select("file_name", "file_type", "file_size_bytes", "file_hash")


@_query("SELECT date_trunc('day', ts) AS window_start, event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2")
def operations_by_window(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    return L.operations_by_window(e).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
