"""The queries of this package: thin digests over the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import table

SHARDS = 16
END_ID = 2


def tokenizer_path() -> str:
    """The word BPE vocabulary that the box offers."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusloom.llm.langid import identify

    return identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusloom.llm.mixing import mix_sources

    mixed = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusloom.llm.substring import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), window=35, with_text=False)


def op4_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusloom.llm.sharding import hilbert_shards

    placed = hilbert_shards(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), SHARDS, carry=["doc_id"])
    return placed.select("row.doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusloom.llm.tokens import token_ids

    return token_ids(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path(), END_ID)


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusloom.llm.decontam import find_leaks

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark"), F.col("text"), [F.col("doc_id")])
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusloom.llm.minhash import classes

    found = classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "class_id")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusloom.llm.lines import drop_frequent_lines

    kept = drop_frequent_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), threshold=10, min_length=1)
    return kept.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusloom.llm.bwt import remove_repeats

    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), window=200, with_text=False)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op10_threshold_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpusloom.llm import sketch as S

    pairs = S.with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))
    pairs = pairs.withColumn("edited", S.edited(F.col("text"), F.col("next_text")))
    sketched = pairs.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        (F.col("text") == F.col("edited")).alias("same_edited"),
        (F.col("text") == F.col("next_text")).alias("same_next"),
        F.array(S.sketch(F.col("text")), S.sketch(F.col("edited")), S.sketch(F.col("next_text"))).alias("s"),
    )
    from corpusloom.llm.common import let

    def digest(s):
        own, new, following = F.get(s, F.lit(0)), F.get(s, F.lit(1)), F.get(s, F.lit(2))
        return F.struct(
            S.encoded(own).alias("fingerprint"),
            S.encoded(new).alias("edited_fingerprint"),
            S.likeness(own, new, F.col("same_edited")).alias("near_edited"),
            S.likeness(own, following, F.col("same_next")).alias("near_next"),
            S.containment(own, new).alias("contained_in_edited"),
        )

    return sketched.withColumn("d", let(F.col("s"), digest)).select("doc_id", "n_chars", "edited_sha256", "d.*")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries by name."""
    found = [v for k, v in globals().items() if k.startswith("op") and k[2].isdigit()]
    return {f.__name__: f for f in found}


LINES_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents),
l AS (SELECT rid, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM d),
k AS (SELECT rid, pos, line, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
hot AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT rid) >= 10),
m AS (SELECT k.*, hot.key IS NOT NULL AS dropped FROM k LEFT JOIN hot ON k.key = hot.key),
g AS (SELECT rid, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
      coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '') AS kept FROM m GROUP BY rid)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_dropped AS BIGINT) AS n_dropped, sha256(kept) AS kept_sha256
FROM d JOIN g USING (rid)
"""


SUBSTRING_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
h AS (SELECT rid, i, md5(array_to_string(w[i : i + 34], ' ')) AS k FROM s),
r AS (SELECT k FROM h GROUP BY k HAVING count(*) > 1),
c AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS p FROM h SEMI JOIN r USING (k)),
l AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
g AS (SELECT rid, count(c.p) AS n_removed, string_agg(word, ' ' ORDER BY l.p) FILTER (c.p IS NULL) AS kept
      FROM l LEFT JOIN c USING (rid, p) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN g USING (rid)
"""

LEAKS_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
n AS (SELECT item_id, w, least(10, len(w)) AS m FROM b WHERE len(w) > 0),
win AS (SELECT item_id, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i : i + m - 1], ' '))) AS k FROM n),
lens AS (SELECT DISTINCT m FROM win),
pos AS (SELECT rid, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM d, lens WHERE len(w) >= m),
occ AS (SELECT rid, m, i, array_to_string(w[i : i + m - 1], ' ') AS k FROM pos),
hit AS (SELECT DISTINCT rid, m, i, item_id FROM occ JOIN win USING (m, k)),
cov AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT rid, unnest(range(i, i + m)) AS p FROM hit) GROUP BY rid),
it AS (SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM hit GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (rid) LEFT JOIN it USING (rid)
"""


BYTES_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, hex(encode(coalesce(text, ''))) AS x FROM documents),
s AS (SELECT rid, x, unnest(range(0, length(x) // 2 - 199)) AS i FROM d WHERE length(x) >= 400),
h AS (SELECT rid, i, md5(substr(x, 2 * i + 1, 400)) AS k FROM s),
r AS (SELECT k FROM h GROUP BY k HAVING count(*) > 1),
w AS (SELECT rid, i FROM h SEMI JOIN r USING (k)),
e AS (SELECT rid, i, coalesce(i > lag(i) OVER (PARTITION BY rid ORDER BY i) + 200, true) AS fresh FROM w),
n AS (SELECT rid, i, sum(fresh::INT) OVER (PARTITION BY rid ORDER BY i) AS span FROM e),
p AS (SELECT rid, span, min(i) AS a, max(i) + 200 AS b FROM n GROUP BY rid, span),
q AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS before FROM p),
g AS (SELECT rid, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last, string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
      FROM q JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head || substr(x, 2 * last + 1), x))) AS kept_sha256
FROM d LEFT JOIN g USING (rid)
"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express on whole tables."""
    return {
        "op3_substring_dedup": SUBSTRING_SQL,
        "op6_benchmark_decontamination": LEAKS_SQL,
        "op8_line_dedup": LINES_SQL,
        "op9_suffix_dedup": BYTES_SQL,
    }
