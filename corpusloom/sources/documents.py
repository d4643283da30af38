"""Reading documents: folders of files, HTML pages, Word files; and writing tables and paragraphs as Markdown."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.cleaning import split_words
from corpusloom.functions.context import SUPPORTED, extension, file_name

#: Bytes of a file that is read as one value; the hash of a larger one comes from a stream.
WHOLE_FILE = 128 << 20
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def scan_directory(spark: SparkSession, folder: str, suffixes: tuple[str, ...] = SUPPORTED, skip_hidden: bool = False) -> DataFrame:
    """Files below a folder with one of the suffixes in any case: path, name, suffix, size, time, SHA-256, content.

    Content and hash are computed only where a query asks for them.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    files = files.where(extension(F.col("path")).isin(*suffixes))
    if skip_hidden:
        files = files.where(~F.startswith(file_name(F.col("path")), F.lit(".")))
    return files.select(
        F.col("path").alias("file_path"),
        file_name(F.col("path")).alias("file_name"),
        extension(F.col("path")).alias("file_type"),
        F.col("length").alias("file_size_bytes"),
        F.col("modificationTime").alias("last_modified"),
        F.sha2("content", 256).alias("file_hash"),
        "content",
    )


def hashed_files(spark: SparkSession, folder: str, suffixes: tuple[str, ...] = SUPPORTED, skip_hidden: bool = False) -> DataFrame:
    """``scan_directory`` without content, for files of any size: the driver hashes those over ``WHOLE_FILE`` block by
    block, one after the other; their content is never held."""
    files = scan_directory(spark, folder, suffixes, skip_hidden).drop("content")
    small, large = files.where(F.col("file_size_bytes") <= WHOLE_FILE), files.where(F.col("file_size_bytes") > WHOLE_FILE).drop("file_hash")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    hashes = []
    for r in large.select("file_path").collect():
        path = jvm.org.apache.hadoop.fs.Path(r[0])
        stream = path.getFileSystem(conf).open(path)
        try:
            hashes.append((r[0], jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)))
        finally:
            stream.close()
    found = spark.createDataFrame(hashes, "file_path string, file_hash string")
    return small.unionByName(large.join(found, "file_path"))


def html_to_text(html: Column) -> Column:
    """Text of a page: scripts, styles, comments and tags out, common entities resolved, blanks and lines normal."""
    t = F.regexp_replace(html, r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", " ")
    t = F.regexp_replace(t, r"(?i)<br\s*/?>|</p>|</div>|</h[1-6]>|</li>|</tr>", "\n")
    t = F.regexp_replace(t, r"<[^>]*>", " ")
    # Entities.
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    t = F.regexp_replace(F.regexp_replace(t, r"[ \t\r]+", " "), r" ?\n[ \n]*", "\n")
    return F.trim(F.regexp_replace(t, r"^\n+|\n+$", ""))


def table_to_markdown(rows: Column) -> Column:
    """An array of rows (arrays of strings) as a Markdown table: ragged rows filled, columns aligned."""

    def render(r: Column) -> Column:
        width = F.array_max(F.transform(r, F.size))
        cols = F.sequence(F.lit(0), width - 1)
        cell = lambda row, i: F.coalesce(F.get(row, i), F.lit(""))
        widths = F.transform(cols, lambda i: F.array_max(F.transform(r, lambda row: F.char_length(cell(row, i)))))

        def with_widths(w: Column) -> Column:
            line = lambda row: F.concat(F.lit("| "), F.array_join(F.transform(w, lambda n, i: F.rpad(cell(row, i), n, F.lit(" "))), " | "), F.lit(" |"))
            rule = F.concat(F.lit("| "), F.array_join(F.transform(w, lambda n: F.repeat(F.lit("-"), n)), " | "), F.lit(" |"))
            lines = F.transform(r, line)
            return F.concat(F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, F.lit(2), F.size(lines))), "\n"), F.lit("\n\n"))

        return F.get(F.transform(F.array(widths), with_widths), F.lit(0))

    return F.when(F.size(rows) > 0, F.get(F.transform(F.array(rows), render), F.lit(0))).otherwise("")


def paragraph_markdown(runs: Column) -> Column:
    """Runs (text, bold, italic) with their marks."""
    mark = lambda r: F.when(r["bold"] & r["italic"], "***").when(r["bold"], "**").when(r["italic"], "*").otherwise("")
    return F.array_join(F.transform(runs, lambda r: F.concat(mark(r), r["text"], mark(r))), "")


def parse_quality(text: Column, markdown: Column) -> Column:
    """(word_count, enough_words, enough_chars, content_ratio, unique_ratio, good)."""
    w = split_words(F.lower(text))
    n = F.size(w)
    ratio = F.char_length(text) / F.greatest(F.char_length(markdown), F.lit(1))
    unique = F.size(F.array_distinct(w)) / F.greatest(n, F.lit(1))
    words_ok, chars_ok = n >= 10, F.char_length(text) >= 50
    return F.struct(
        n.alias("word_count"), words_ok.alias("enough_words"), chars_ok.alias("enough_chars"), ratio.alias("content_ratio"), unique.alias("unique_ratio"),
        (words_ok & chars_ok & (ratio > 0.3) & (unique > 0.1)).alias("good"),
    )


def markdown_rows(rows: list[list[str | None]]) -> str:
    """``table_to_markdown`` for rows in Python."""
    if not rows:
        return ""
    n = max(map(len, rows))
    filled = [[(c or "") for c in r] + [""] * (n - len(r)) for r in rows]
    widths = [max(len(r[i]) for r in filled) for i in range(n)]
    lines = ["| " + " | ".join(c.ljust(w) for c, w in zip(r, widths, strict=True)) + " |" for r in filled]
    return "\n".join([lines[0], "| " + " | ".join("-" * w for w in widths) + " |", *lines[1:]]) + "\n\n"


@dataclass(frozen=True)
class Parsed:
    """What a file says: Markdown, plain text, pages, and its properties as JSON."""

    markdown: str
    text: str
    pages: int
    properties: str


def _mark(text: str, bold: bool, italic: bool) -> str:
    mark = "***" if bold and italic else "**" if bold else "*" if italic else ""
    return mark + text + mark


def _word_table(table: ElementTree.Element) -> list[list[str | None]]:
    text = lambda cell: "\n".join("".join(t.text or "" for t in p.iter(f"{_W}t")) for p in cell.iter(f"{_W}p")).strip()
    return [[text(c) for c in row.findall(f"{_W}tc")] for row in table.findall(f"{_W}tr")]


# Properties of a Word file by the names of its core part.
_PROPERTIES = {"title": "title", "creator": "author", "subject": "subject", "created": "created", "modified": "modified"}


def parse_docx(content: bytes) -> Parsed:
    """A Word file: paragraphs first and tables after them, as one page. Headings and tables are in the Markdown only."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{_W}body")
        core = ElementTree.fromstring(z.read("docProps/core.xml")) if "docProps/core.xml" in z.namelist() else []
    found = {e.tag.rsplit("}", 1)[-1]: e.text for e in core}
    marked, plain = [], []
    for p in body.findall(f"{_W}p"):
        style = p.find(f"{_W}pPr/{_W}pStyle")
        name = style.get(f"{_W}val", "") if style is not None else ""
        runs = []
        for r in p.iter(f"{_W}r"):
            bold, italic = (r.find(f"{_W}rPr/{_W}{k}") is not None for k in "bi")
            runs.append(("".join(x.text or "" for x in r.iter(f"{_W}t")), bold, italic))
        text = "".join(t for t, _, _ in runs)
        if not text.strip():
            continue
        if name.lower().startswith("heading"):
            level = name[7:].strip()
            marked.append("#" * min(6, max(1, int(level) if level.isdigit() else 1)) + " " + text + "\n")
        else:
            marked.append("".join(_mark(*r) for r in runs if r[0]))
            plain.append(text)
    marked += [markdown_rows(rows) for t in body.findall(f"{_W}tbl") if (rows := _word_table(t))]
    return Parsed("\n".join(marked), "\n".join(plain), 1, json.dumps({v: found.get(k) for k, v in _PROPERTIES.items()}))


def page_markdown(page: dict, tables: list[list[list[str | None]]], number: int, headings: bool = True) -> tuple[str, str]:
    """Markdown and text of a PDF page from its blocks (of lines of spans with ``text``, ``size`` and ``flags``).

    Spans in type above 14 points are headings, the larger the higher, to the third level; bit 4 of the flags is bold,
    bit 1 italic. Tables come after the lines, and a rule with the page's number after a page that has anything.
    Without ``headings``, lines that end in one are left out of the Markdown (and stay in the text).
    """
    texts, marked = [], []
    for line in (ln for block in page["blocks"] for ln in block.get("lines", ())):
        plain, out, last = [], "", False
        for span in line["spans"]:
            t = span["text"].strip()
            if not t:
                continue
            plain.append(t)
            last = span.get("size", 12) > 14
            flags = span.get("flags", 0)
            out += "#" * min(3, max(1, int((span["size"] - 12) / 2))) + f" {t}\n\n" if last else _mark(t, bool(flags & 16), bool(flags & 2)) + " "
        if plain:
            texts.append(" ".join(plain))
            if headings or not last:
                marked.append(out.strip())
    marked += [markdown_rows(rows) for rows in tables if rows]
    md = "\n".join(marked)
    return md + (f"\n\n---\n*Page {number}*\n\n" if md else ""), "\n".join(texts)


def parse_pdf(content: bytes) -> Parsed:
    """A PDF file, where the optional library is installed."""
    import fitz

    with fitz.open(stream=content, filetype="pdf") as doc:
        pages = [page_markdown(p.get_text("dict"), [t.extract() for t in p.find_tables()], i + 1) for i, p in enumerate(doc)]
        return Parsed("\n\n".join(m for m, _ in pages), "\n\n".join(t for _, t in pages), len(pages), json.dumps(dict(doc.metadata or {})))


#: Parsers by suffix; further kinds of files are added by the caller.
PARSERS: dict[str, Callable[[bytes], Parsed]] = {".docx": parse_docx, ".pdf": parse_pdf}


def parse_documents(files: DataFrame, parsers: dict[str, Callable[[bytes], Parsed]] | None = None) -> DataFrame:
    """``file_path``, ``markdown``, ``raw_text``, ``page_count``, ``document_metadata`` (JSON), ``error``, ``word_count``,
    ``parsing_success``.

    What fails, or has a suffix that no parser is for, is a row with its error, never an exception.
    """
    known = dict(PARSERS if parsers is None else parsers)

    def one(path: str, content: bytes) -> tuple[str | None, str | None, int | None, str | None, str | None]:
        suffix = "." + path.rsplit(".", 1)[-1].lower()
        try:
            if suffix not in known:
                return None, None, None, None, f"Unsupported file type: {suffix[1:]}"
            p = known[suffix](content)
            return p.markdown, p.text, p.pages, p.properties, None
        except Exception as e:  # a broken file is a result
            return None, None, None, None, f"{type(e).__name__}: {e}"

    names = ["file_path", "markdown", "raw_text", "page_count", "document_metadata", "error"]
    types = [pa.string(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(p, *one(p, c)) for p, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
            cols = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    parsed = files.select("file_path", "content").mapInArrow(run, "file_path string, markdown string, raw_text string, page_count int, document_metadata string, error string")
    return parsed.withColumns({"word_count": F.size(split_words(F.coalesce("raw_text", F.lit("")))), "parsing_success": F.col("error").isNull()})


def write_report(rows: DataFrame, path: str) -> None:
    """A report as JSON lines."""
    rows.write.mode("overwrite").json(path)
