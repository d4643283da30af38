"""Boundary-aware chunking: boundaries, the cut loop, and what is derived from chunks."""

from __future__ import annotations

import bisect
import re
import sys
import time
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom import config
from corpusloom.functions import describe as D
from corpusloom.functions.cleaning import U, let, split_words, strip

SENTENCE, PARAGRAPH, SECTION, TABLE = 1, 3, 10, 8
_TOKEN = re.compile(r"\w+|[^\w\s]")


#: The families of boundaries that the cut loop knows.
FAMILIES = ("sentence", "paragraph", "section", "table")


@dataclass(frozen=True)
class Cuts:
    """Sizes in tokens of about four characters; ``lossless`` adds what the loop leaves at the end as a last chunk;
    ``families`` are the kinds of boundaries that it prefers, headings and tables before paragraphs and sentences."""

    size: int = config.CHUNK_SIZE
    overlap: int = config.CHUNK_OVERLAP
    minimum: int = config.MIN_CHUNK
    limit: int = config.TOKEN_LIMIT
    lossless: bool = True
    fallback: str = "tokens"  # where no boundary is near: the end of ``size`` tokens, or of 4 * ``size`` "chars"
    families: tuple[str, ...] = FAMILIES


def token_count(text: Column) -> Column:
    """Words and single punctuation marks."""
    return F.coalesce(F.regexp_count(text, F.lit(rf"{U}\w+|[^\w\s]")), F.lit(0))


def split_by_tokens(text: Column, most: int) -> Column:
    """Pieces of at most so many tokens, joined by spaces."""
    tokens = F.regexp_extract_all(text, F.lit(rf"{U}(\w+|[^\w\s])"), F.lit(1))
    starts = F.sequence(F.lit(1), F.greatest(F.size(tokens), F.lit(1)), F.lit(most))
    return F.filter(F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, F.lit(most)), " ")), lambda p: p != "")


def running_sums(numbers: Column, block: int = 256) -> Column:
    """The sums of all first numbers of an array, block by block, so that the work is not the square of its length."""
    none = F.array().cast("array<int>")
    last = lambda sums: F.coalesce(F.get(sums, F.size(sums) - 1), F.lit(0))
    inside = lambda xs: F.aggregate(xs, none, lambda sums, n: F.concat(sums, F.array(last(sums) + n)))
    starts = F.sequence(F.lit(1), F.greatest(F.size(numbers), F.lit(1)), F.lit(block))
    blocks = F.transform(starts, lambda i: inside(F.slice(numbers, i, F.lit(block))))

    def joined(parts: Column) -> Column:
        bases = inside(F.transform(parts, last))
        return F.flatten(F.zip_with(parts, bases, lambda part, base: F.transform(part, lambda x: x + base - last(part))))

    return F.when(F.size(numbers) > 0, F.get(F.transform(F.array(blocks), joined), F.lit(0))).otherwise(none)


def _ends(text: Column, pattern: str) -> Column:
    """Where the matches of a pattern end: after each, as many characters as all text up to it has. Every match begins
    where the one before has ended, so a text without one is read once."""
    pieces = F.regexp_extract_all(text, F.lit(rf"(?s)\G.*?{pattern}"), F.lit(0))
    return F.get(F.transform(F.array(F.transform(pieces, F.char_length)), lambda sizes: running_sums(sizes)), F.lit(0))


def sentence_boundaries(text: Column) -> Column:
    """Where sentences end, the white space after them included."""
    return _ends(text, rf"{U}[.!?]\s+")


def paragraph_boundaries(text: Column) -> Column:
    """Where blank lines end."""
    return _ends(text, rf"{U}\n\s*\n")


def section_boundaries(documents: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``position``, ``level``, ``priority`` of each Markdown heading line."""
    lines = documents.select(key, F.posexplode(F.split(text, "\n", -1)).alias("n", "line"))
    before = F.sum(F.char_length("line") + 1).over(Window.partitionBy(key).orderBy("n").rowsBetween(Window.unboundedPreceding, -1))
    placed = lines.withColumn("position", F.coalesce(before, F.lit(0)).cast("int")).where(F.regexp_like("line", F.lit(rf"{U}^#{{1,6}}\s+.+$")))
    level = F.char_length(F.regexp_extract("line", "^(#+)", 1))
    return placed.select(key, "position", level.alias("level"), (SECTION - level).alias("priority"))


def table_boundaries(documents: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``start``, ``end`` of each run of lines that are table rows with a rule as second line."""
    lines = documents.select(key, F.posexplode(F.split(text, "\n", -1)).alias("n", "line"))
    w = Window.partitionBy(key).orderBy("n")
    lines = lines.withColumn("start", F.coalesce(F.sum(F.char_length("line") + 1).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("int"))
    row = F.regexp_like("line", F.lit(r"^\s*\|.*\|\s*$"))
    marked = lines.withColumn("row", row).withColumn("run", F.sum((~row).cast("int")).over(w)).where("row")
    runs = marked.groupBy(key, "run").agg(
        F.min("start").alias("start"), F.max(F.col("start") + F.char_length("line")).alias("end"), F.min_by("line", "n").alias("first"), F.sort_array(F.collect_list(F.struct("n", "line"))).alias("rows")
    )
    rule = F.regexp_like(F.get("rows", F.lit(1))["line"], F.lit(r"^\s*\|[\s:|-]*-[\s:|-]*\|\s*$"))
    return runs.where(rule).select(key, "start", "end")


_HEADING = re.compile(r"^#{1,6}\s+.+$", re.M)
_ROW, _RULE = re.compile(r"\s*\|.*\|\s*"), re.compile(r"\s*\|[\s:|-]*-[\s:|-]*\|\s*")


def places_of(text: str, markdown: str, families: tuple[str, ...] = FAMILIES) -> dict[int, int]:
    """Positions of boundaries with the highest priority of each. Sentences and paragraphs are found in the text,
    headings and tables in its Markdown; positions in both are taken as the same."""
    found: dict[int, int] = {}

    def add(at: int, priority: int) -> None:
        found[at] = max(priority, found.get(at, 0))

    for family, pattern, priority in (("sentence", r"[.!?]\s+", SENTENCE), ("paragraph", r"\n\s*\n", PARAGRAPH)):
        if family in families:
            for m in re.finditer(pattern, text):
                add(m.end(), priority)
    if "section" in families:
        for m in _HEADING.finditer(markdown):
            add(m.start(), SECTION - len(m.group().split()[0]))
    if "table" in families and "|" in markdown:
        at, rows = 0, []  # rows: (start, end, line) of the run of table lines so far
        for line in [*markdown.split("\n"), ""]:
            if _ROW.fullmatch(line):
                rows.append((at, at + len(line), line))
            else:
                if len(rows) > 1 and _RULE.fullmatch(rows[1][2]):
                    add(rows[0][0], TABLE)
                    add(rows[-1][1], TABLE)
                rows = []
            at += len(line) + 1
    return found


def cut(text: str, how: Cuts, markdown: str | None = None) -> list[tuple[int, str, int, int, float]]:
    """Chunks of a text: (index, stripped text, start, end, position)."""
    found = places_of(text, text if markdown is None else markdown, how.families)
    places = sorted(found)
    n, advance, out, pos, end = len(text), max(100, 2 * how.size), [], 0, 0

    def emit(a: int, b: int) -> None:
        body = text[a:b].strip()
        if not body:
            return
        tokens = _TOKEN.findall(body) if len(body) > how.limit else []
        if len(tokens) > how.limit:
            for i in range(0, len(tokens), how.size):
                out.append((len(out), " ".join(tokens[i : i + how.size]), a, b, a / n))
        else:
            out.append((len(out), body, a, b, a / n))

    while pos < n:
        target = pos + 4 * how.size
        near = places[bisect.bisect_left(places, target - 2 * how.size) : bisect.bisect_right(places, target + 2 * how.size)]
        if near:
            end = min(min(near, key=lambda p: (-found[p], abs(p - target), p)), n)
        elif how.fallback == "chars":
            end = min(target, n)
        else:
            end = n
            for i, m in enumerate(_TOKEN.finditer(text, pos), 1):
                if i == how.size:
                    end = m.end()
                    break
        if end - pos < 4 * how.minimum:
            end = min(pos + 4 * how.minimum, n)
        emit(pos, end)
        pos = max(end - 4 * how.overlap, pos + advance)
        if pos >= n - advance:
            break
    if how.lossless and end < n:
        emit(end, n)
    return out


def chunk(documents: DataFrame, key: str = "doc_id", text: str = "text", how: Cuts = Cuts(), markdown: str | None = None) -> DataFrame:
    """One row per chunk: ``key``, ``chunk_index``, ``chunk_text``, ``char_start``, ``char_end``, ``position``.

    Headings and tables are looked for in the column ``markdown``, or in the text itself. The loop is sequential inside
    a text, so it runs in Arrow batches; null and blank texts give no chunk.
    """
    thin = documents.select(F.col(key), F.col(text).cast("string").alias("text"), F.col(markdown or text).cast("string").alias("markdown"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)
            rows = [(i, *c) for i, (t, m) in enumerate(pairs) if t for c in cut(t, how, m or "")]
            at, index, body, start, end, position = zip(*rows, strict=True) if rows else [()] * 6
            arrays = [b.column(0).take(pa.array(at, pa.int64())), pa.array(index, pa.int32()), pa.array(body, pa.string()), pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(position, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[key, "chunk_index", "chunk_text", "char_start", "char_end", "position"])

    kind = thin.schema[key].dataType.simpleString()
    return thin.mapInArrow(run, f"{key} {kind}, chunk_index int, chunk_text string, char_start int, char_end int, position double")


def is_empty(text: Column) -> Column:
    """Fewer than ten characters between white space: a form or template without content."""
    return F.char_length(strip(F.coalesce(text, F.lit("")))) < 10


def synthetic_chunks(documents: DataFrame, key: str, text: str, ctx: Column, size: Column) -> DataFrame:
    """The one chunk of each document that ``is_empty``: a description of it from its path, name and size."""
    found = let(ctx, lambda c: F.struct(D.searchable_text(c).alias("chunk_text"), D.metadata(c, size).alias("described"), c["file_name"].alias("__name")))
    rows = documents.where(is_empty(F.col(text))).select(key, found.alias("__d")).select(key, "__d.*")
    n = F.char_length("chunk_text")
    return rows.select(
        key, F.lit(0).alias("chunk_index"), "chunk_text", F.lit(0).alias("char_start"), n.alias("char_end"), F.lit(0.0).alias("position"),
        F.concat(F.lit("# "), F.col("__name"), F.lit("\n\n"), F.col("chunk_text")).alias("chunk_markdown"), "described",
    )


def chunk_documents(
    documents: DataFrame, ctx: Column, key: str = "doc_id", text: str = "text", markdown: str | None = None, path: Column | None = None, size: Column | None = None, how: Cuts = Cuts(), synthetic: bool = True
) -> DataFrame:
    """``chunk``, and for documents without content the described form's chunk (unless not ``synthetic``), each with
    ``chunk_markdown``, ``token_count``, ``chunk_hash``, ``section_title`` and the struct ``context_metadata``.

    ``ctx`` is the document's context struct, ``path`` and ``size`` its file's path and bytes (the relative path and 0
    where they are not given). Metadata of a described form comes before the document's own: its type of document is the
    form's, and it has a score, keywords and uses; those are null elsewhere.
    """
    rows = documents.withColumns({"__ctx": ctx, "__path": path if path is not None else ctx["relative_path"], "__size": size if size is not None else F.lit(0)})
    cuts = chunk(rows.where(~is_empty(F.col(text))), key, text, how, markdown)
    described = synthetic_chunks(rows, key, text, F.col("__ctx"), F.col("__size"))
    kind = described.schema["described"].dataType.simpleString()
    cuts = cuts.withColumns({"chunk_markdown": F.col("chunk_text"), "described": F.lit(None).cast(kind)})
    every = (cuts.unionByName(described) if synthetic else cuts).join(rows.select(key, "__ctx", "__path"), key)
    every = every.withColumns({"token_count": token_count(F.col("chunk_text")), "chunk_hash": chunk_hash(F.col("chunk_text")), "__flags": structure_flags(F.col("chunk_markdown"))})
    flags = [F.when(F.col(f"__flags.has_{k}"), k) for k in ("table", "list", "heading")]
    c, d = F.col("__ctx"), F.col("described")
    meta = F.struct(
        F.col("__path").alias("file_path"),
        *[c[n].alias(n) for n in ("file_name", "policy_manual", "policy_acronym", "section", "document_index")],
        F.coalesce(d["document_type"], c["document_type"]).alias("document_type"),
        *[c[n].alias(n) for n in ("is_additional_resource", "hierarchy_path")],
        F.col("chunk_index"),
        F.col("position").alias("chunk_position"),
        F.array_compact(F.array(*flags)).alias("structural_elements"),
        F.col("token_count"),
        F.coalesce(d["synthetic_description"], F.lit(False)).alias("synthetic_description"),
        *[d[n].alias(n) for n in ("confidence_score", "generated_keywords", "use_cases", "original_description")],
    )
    title = F.regexp_extract("chunk_markdown", r"(?m)^#{1,6}[ \t]+(.+)$", 1)
    return every.select(key, "chunk_index", "chunk_text", "chunk_markdown", "char_start", "char_end", "position", "token_count", "chunk_hash", F.nullif(title, F.lit("")).alias("section_title"), meta.alias("context_metadata"))


class Tokenizer(Protocol):
    """Cuts a text into tokens and joins tokens to a text; runs on the workers in Arrow batches."""

    def tokens(self, text: str) -> list[str]: ...

    def join(self, tokens: list[str]) -> str: ...


@dataclass(frozen=True)
class WordTokenizer:
    """Words and single punctuation marks; the same tokens as ``token_count``."""

    def tokens(self, text: str) -> list[str]:
        return _TOKEN.findall(text)

    def join(self, tokens: list[str]) -> str:
        return " ".join(tokens)


@dataclass(frozen=True)
class FileTokenizer:
    """The tokenizer of a file of the tokenizers library, without special tokens."""

    path: str

    def _load(self):
        kept = vars(sys).setdefault("_corpusloom_tokenizers", {})
        if self.path not in kept:
            from tokenizers import Tokenizer as Library

            kept[self.path] = Library.from_file(self.path)
        return kept[self.path]

    def tokens(self, text: str) -> list[str]:
        return self._load().encode(text, add_special_tokens=False).tokens

    def ids(self, text: str) -> list[int]:
        return self._load().encode(text, add_special_tokens=False).ids

    def join(self, tokens: list[str]) -> str:
        library = self._load()
        return library.decode([library.token_to_id(t) for t in tokens])


def tokenized(documents: DataFrame, key: str, text: str, tokenizer: Tokenizer, most: int) -> DataFrame:
    """``key``, ``tokens`` (their number) and ``parts``: the text if it has at most so many tokens, else runs of them."""
    thin = documents.select(key, F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            numbers, parts = [], []
            for t in b.column(1).to_pylist():
                found = tokenizer.tokens(t) if t else []
                numbers.append(len(found))
                parts.append([t or ""] if len(found) <= most else [tokenizer.join(found[i : i + most]).strip() for i in range(0, len(found), most)])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(numbers, pa.int32()), pa.array(parts, pa.list_(pa.string()))], names=[key, "tokens", "parts"])

    return thin.mapInArrow(run, f"{key} {thin.schema[key].dataType.simpleString()}, tokens int, parts array<string>")


def register_chunker(spark: SparkSession, name: str = "chunk_text", how: Cuts = Cuts()) -> None:
    """The chunker as a table function for SQL: ``SELECT ... FROM t, LATERAL chunk_text(t.text)``."""
    from pyspark.sql.functions import udtf

    class Chunker:
        def eval(self, text: str):
            if text:
                yield from cut(text, how)

    spark.udtf.register(name, udtf(Chunker, returnType="chunk_index int, chunk_text string, char_start int, char_end int, position double"))


def chunk_hash(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, 16)


def structure_flags(text: Column) -> Column:
    """Which of table, list and heading a chunk holds."""
    return F.struct(
        (F.contains(text, F.lit("|")) & F.contains(text, F.lit("-"))).alias("has_table"),
        F.regexp_like(text, F.lit(r"(?Udm)^\s*[-*+]\s")).alias("has_list"),
        F.regexp_like(text, F.lit(r"(?Udm)^#{1,6}\s")).alias("has_heading"),
    )


def section_titles(text: Column, start: Column) -> Column:
    """The nearest capital lines before a position: the last is the subsection, the one before it the section."""
    lines = F.transform(F.split(F.substring(text, F.lit(1), start), "\n", -1), strip)
    caps = F.filter(lines, lambda x: (F.upper(x) == x) & (F.lower(x) != x) & (F.char_length(x) < 100))
    return F.struct(F.get(F.reverse(caps), F.lit(1)).alias("section"), F.get(F.reverse(caps), F.lit(0)).alias("subsection"))


def surrounding_context(chunks: DataFrame, key: str, order: str, text: str, words: int = config.CONTEXT_WORDS) -> DataFrame:
    """``context``: the last words of the chunk before and the first of the one after; null without neighbours."""
    w = Window.partitionBy(key).orderBy(order)
    before, after = split_words(F.lag(text).over(w)), split_words(F.lead(text).over(w))
    tail = F.slice(before, F.greatest(F.size(before) - words + 1, F.lit(1)), F.lit(words))
    left = F.when(F.size(before) > 0, F.concat(F.lit("..."), F.array_join(tail, " ")))
    right = F.when(F.size(after) > 0, F.concat(F.array_join(F.slice(after, 1, words), " "), F.lit("...")))
    return chunks.withColumn("context", F.nullif(F.concat_ws(" | ", left, right), F.lit("")))


def preservation(cuts: Column, boundaries: Column, within: int = 20) -> Column:
    """The share of boundaries with a chunk's start or end closer than so many characters; 1 without boundaries."""
    kept = F.size(F.filter(boundaries, lambda b: F.exists(cuts, lambda c: F.abs(c - b) < within)))
    return F.when(F.size(boundaries) == 0, 1.0).otherwise(kept / F.size(boundaries))


def document_stats(chunks: DataFrame, key: str, tokens: Column, how: Cuts = Cuts()) -> DataFrame:
    """Chunks, tokens, mean size and overlap share by document."""
    return chunks.groupBy(key).agg(
        F.count("*").alias("total_chunks"), F.sum(tokens).alias("total_tokens"), F.avg(tokens).alias("avg_tokens"), F.lit(how.overlap / how.size).alias("overlap_ratio")
    )


def quality(issues: Column, kept: Column, deviation: Column, mean: Column) -> Column:
    """1 less a tenth an issue, more a fifth of preservation, less a fifth if sizes vary by over half; from 0 to 1."""
    varied = F.when((mean > 0) & (deviation / mean > 0.5), 0.2).otherwise(0.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1.0 - 0.1 * issues + 0.2 * kept - varied))


def boundaries(documents: DataFrame, key: str, text: str, markdown: str | None = None) -> DataFrame:
    """``key`` and ``bounds``, the positions of all boundaries of the four families, in order."""
    md = markdown or text
    own = documents.select(key, F.array_union(sentence_boundaries(F.coalesce(text, F.lit(""))), paragraph_boundaries(F.coalesce(text, F.lit("")))).alias("b"))
    sections = section_boundaries(documents, key, md).select(key, "position")
    tables = table_boundaries(documents, key, md).select(key, F.explode(F.array("start", "end")).alias("position"))
    more = sections.union(tables).groupBy(key).agg(F.collect_set("position").alias("m"))
    return own.join(more, key, "left").select(key, F.array_sort(F.array_union("b", F.coalesce("m", F.array().cast("array<int>")))).alias("bounds"))


def validation(chunks: DataFrame, bounds: DataFrame, key: str, minimum: int = config.MIN_CHUNK, most: int = config.TOKEN_LIMIT) -> DataFrame:
    """By document: ``total_chunks``, ``avg_chunk_size``, ``preservation``, ``issues`` (texts) and ``quality_score``.

    ``chunks`` has ``chunk_text``, ``char_start``, ``char_end``; ``bounds`` comes from ``boundaries``.
    """
    sized = chunks.withColumn("__tokens", token_count(F.col("chunk_text")))
    n = F.col("__tokens")
    per = sized.groupBy(key).agg(
        F.count("*").alias("total_chunks"), F.avg(n).alias("avg_chunk_size"), F.stddev_pop(n).alias("deviation"), F.count_if(n < minimum).alias("small"), F.count_if(n > most).alias("large"),
        F.count_if(strip(F.col("chunk_text")) == "").alias("empty"), F.array_union(F.collect_set("char_start"), F.collect_set("char_end")).alias("cuts"),
    )
    texts = (("small", " chunks below minimum size"), ("large", " chunks above maximum size"), ("empty", " empty chunks"))
    issues = F.array_compact(F.array(*[F.when(F.col(c) > 0, F.concat(F.col(c).cast("string"), F.lit(t))) for c, t in texts]))
    rows = per.join(bounds, key).withColumns({"issues": issues, "preservation": preservation(F.col("cuts"), F.col("bounds"))})
    score = quality(F.size("issues"), F.col("preservation"), F.col("deviation"), F.col("avg_chunk_size"))
    return rows.select(key, "total_chunks", "avg_chunk_size", "preservation", "issues", score.alias("quality_score"))


def validation_means(validated: DataFrame) -> DataFrame:
    """Documents and the means over them."""
    names = {"quality_score": "avg_quality", "total_chunks": "avg_chunks", "avg_chunk_size": "avg_chunk_size", "preservation": "avg_preservation"}
    return validated.agg(F.count("*").alias("documents"), *[F.avg(c).alias(a) for c, a in names.items()])


def common_issues(validated: DataFrame, most: int = 5) -> DataFrame:
    """The most common issues and how often each occurs; ties by text."""
    each = validated.select(F.explode("issues").alias("issue")).groupBy("issue").agg(F.count("*").alias("n"))
    return each.orderBy(F.desc("n"), "issue").limit(most)


def tune(documents: DataFrame, sizes: list[int], overlaps: list[int], key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each size and overlap below it: chunks, documents, mean tokens, boundary preservation, and the milliseconds
    that cutting took for each document, on the workers."""
    out = None
    thin = documents.select(key, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    bounds = boundaries(thin, key, "text")
    kind = thin.schema[key].dataType.simpleString()

    def timed(how: Cuts):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = []
                for t in b.column(1).to_pylist():
                    began = time.perf_counter()
                    cuts = cut(t, how) if t else []
                    spent = (time.perf_counter() - began) * 1000
                    rows.append((len(cuts), sum(len(_TOKEN.findall(c[1])) for c in cuts), sorted({x for c in cuts for x in c[2:4]}), spent))
                n, tokens, at, ms = zip(*rows, strict=True) if rows else [()] * 4
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(tokens, pa.int64()), pa.array(at, pa.list_(pa.int32())), pa.array(ms, pa.float64())], names=[key, "n", "tokens", "cuts", "ms"])

        return run

    for size in sizes:
        for overlap in (o for o in overlaps if o < size):
            per = thin.mapInArrow(timed(Cuts(size=size, overlap=overlap, fallback="chars")), f"{key} {kind}, n long, tokens long, cuts array<int>, ms double").where("n > 0")
            kept = per.join(bounds, key).select("n", "tokens", "ms", preservation(F.col("cuts"), F.col("bounds")).alias("kept"))
            row = kept.agg(F.sum("n").alias("chunks"), F.count("*").alias("documents"), (F.sum("tokens") / F.sum("n")).alias("avg_tokens"), F.avg("kept").alias("preservation"), F.avg("ms").alias("avg_ms"))
            row = row.select(F.lit(size).alias("size"), F.lit(overlap).alias("overlap"), "*")
            out = row if out is None else out.union(row)
    return out


def best_cuts(tuned: DataFrame, most: int = 10) -> DataFrame:
    """The settings that preserve most, of equal ones the fastest first; ``best`` marks the first."""
    top = tuned.orderBy(F.desc("preservation"), "avg_ms", "size", "overlap").limit(most)
    rank = F.row_number().over(Window.orderBy(F.desc("preservation"), "avg_ms", "size", "overlap"))  # ``most`` rows
    return top.withColumn("best", rank == 1)
