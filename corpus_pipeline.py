"""From raw documents to token files: five stages, each one of the corpus operators.

A stage takes (spark, documents, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import decontam, langid, minhash, mixing, tokens
from corpusloom.llm.common import numbered
from corpusloom.llm.queries import END_ID, tokenizer_path
from corpusloom.session import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a learned language. Rejected: texts without a letter, and texts that cost more bits a byte than
    unseen texts of the language do (see ``langid.bounds``). A null language is filled with the prediction. Where no row
    has a language nothing is learned, and every document stays."""
    model = langid.fit_on(docs, langid.SPARE)
    if not model.languages:
        return docs
    limits = langid.bounds(docs, model)
    rows = numbered(docs)
    text = rows.columns[docs.columns.index("text")]
    found = langid.predict(rows, model, text, *rows.columns)
    kept = found.where(~langid.is_foreign(limits, F.col("lang_pred"), F.col("bits"), F.octet_length(text)))
    return kept.select(*[F.coalesce(n, "lang_pred").alias(c) if c == "lang" else F.col(n).alias(c) for n, c in zip(rows.columns, docs.columns, strict=True)])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near duplicates."""
    return minhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in which no window of a benchmark item occurs."""
    rows = numbered(docs)
    found = decontam.find_leaks(rows, table(spark, sf_dir, "benchmark"), rows.columns[docs.columns.index("text")], rows.columns)
    return found.where(F.size("spans") == 0).select(*[F.col(n).alias(c) for n, c in zip(rows.columns, docs.columns, strict=True)])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of its source takes it."""
    return mixing.repeated(mixing.mix_sources(docs))


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the token files; one row per document as read back from them."""
    return tokens.token_ids(docs, tokenizer_path(), END_ID)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
    ("token_files", token_files),
]

#: No stage but the third has SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written before the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
