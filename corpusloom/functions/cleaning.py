"""Text cleaning as Column expressions: notices, headers and footers, noise, white space, statistics."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import config
from corpusloom.functions.phrases import phrase_counts, phrase_histogram  # noqa: F401

#: Unicode classes and \n as the only line end.
U = "(?Ud)"


#: White space of any kind, as Unicode has it.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """White space of any kind off both ends."""
    return F.btrim(text, F.lit(SPACES))


def split_words(text: Column) -> Column:
    """Words between white space of any kind."""
    return F.filter(F.split(text, rf"{U}\s+"), lambda w: w != "")


def literal(pattern: str) -> str:
    """The longest run of plain characters that every match of a pattern has; empty where none is plain to see."""
    best, run, i, depth = "", "", 0, 0
    if "|" in re.sub(r"\\.", "", pattern):
        return ""
    while i <= len(pattern):
        c = pattern[i] if i < len(pattern) else ""
        plain = ""
        if c == "\\":
            i += 1
            plain = pattern[i] if not pattern[i].isalnum() else ""
        elif c == "[":
            i = pattern.index("]", i + 1)
        elif c and c not in ".^$*+?{}()":
            plain = c
        depth += (c == "(") - (c == ")")
        after = pattern[i + 1 : i + 2]
        if plain and not depth and after not in ("?", "*", "{"):
            run += plain
        else:
            best, run = max(best, run, key=len), ""
        if c == "{":
            i = pattern.index("}", i)
        if plain and after == "+":
            best, run = max(best, run, key=len), ""
        i += 1
    return best


def _chain(text: Column, patterns: Iterable[str], flags: str) -> Column:
    """Patterns removed one after another; a pattern is only looked for where its plain characters stand in the text."""

    def without(p: str) -> Callable[[Column], Column]:
        plain = literal(p)
        cut = lambda t: F.regexp_replace(t, F.lit(f"(?Ud{flags}){p}"), F.lit(""))
        if len(plain) < 2:
            return cut
        if "i" not in flags:
            return lambda t: F.when(F.contains(t, F.lit(plain)), cut(t)).otherwise(t)
        # letters that are no others' lower case and yet match them
        odd = lambda t: F.contains(t, F.lit("\u017f")) | F.contains(t, F.lit("\u0131")) | F.contains(t, F.lit("\u0130"))
        return lambda t: F.when(F.contains(F.lower(t), F.lit(plain.lower())) | odd(t), cut(t)).otherwise(t)

    for p in patterns:
        text = let(text, without(p))
    return text


def remove_disclaimers(text: Column, organisation: config.Organisation = config.Organisation()) -> Column:
    """Notices removed one after another."""
    return _chain(text, organisation.disclaimers(), "is")


def remove_noise(text: Column) -> Column:
    """Page numbers, stamps, paths, addresses, empty cells, rules and dotted leaders removed."""
    return _chain(text, config.NOISE_PATTERNS, "m")


def pattern_counts(text: Column, patterns: list[str], kind: str, flags: str) -> Column:
    """How often each pattern would be removed in turn: array of (kind, pattern, count), counts above 0."""
    out = []
    for i, p in enumerate(patterns):
        p = f"(?Ud{flags}){p}"
        out.append(F.struct(F.lit(kind).alias("kind"), F.lit(i).alias("pattern"), F.regexp_count(text, F.lit(p)).alias("count")))
        text = F.regexp_replace(text, F.lit(p), F.lit(""))
    return F.filter(F.array(*out), lambda s: s["count"] > 0)


def _often(stripped: Column, more_than: int) -> Column:
    ordered = F.sort_array(F.filter(stripped, lambda x: x != ""))
    return let(ordered, lambda o: F.array_distinct(F.filter(o, lambda x, i: x == F.get(o, i + more_than))))


def repeated_lines(text: Column, more_than: int = config.REPEATED_LINE) -> Column:
    """Stripped lines that occur more than so many times, each once."""
    return _often(F.transform(F.split(text, "\n", -1), strip), more_than)


def remove_headers_footers(text: Column, more_than: int = config.REPEATED_LINE) -> Column:
    """Blank lines stay; lines that repeat too often or look like headers or footers go. Each line is stripped once."""
    header = F.lit("(?Udi)" + "|".join(f"(?:{p})" for p in config.HEADER_PATTERNS))

    def kept(lines: Column) -> Column:
        stripped = F.transform(lines, lambda p: p["s"])
        stay = lambda often: F.filter(lines, lambda p: (p["s"] == "") | (~F.array_contains(often, p["s"]) & ~F.regexp_like(p["s"], header)))
        return F.array_join(F.transform(let(_often(stripped, more_than), stay), lambda p: p["line"]), "\n")

    return let(F.transform(F.split(text, "\n", -1), lambda x: F.struct(x.alias("line"), strip(x).alias("s"))), kept)


def header_counts(text: Column, more_than: int = config.REPEATED_LINE) -> Column:
    """Which lines ``remove_headers_footers`` takes, and why: array of (kind, pattern, count). A repeated line counts as
    often as it occurs; a header pattern counts the lines that it is the first to match."""

    def first(line: Column) -> Column:
        """The first header pattern that matches."""
        return F.coalesce(*[F.when(F.regexp_like(line, F.lit(f"(?Udi){p}")), p) for p in config.HEADER_PATTERNS])

    def counted(stripped: Column) -> Column:
        def of(often: Column) -> Column:
            lines = F.transform(often, lambda x: F.struct(F.lit("repeated_line").alias("kind"), x.alias("pattern"), F.size(F.filter(stripped, lambda s: s == x)).alias("count")))
            rest = F.filter(stripped, lambda s: (s != "") & ~F.array_contains(often, s))
            names = F.array_compact(F.transform(rest, first))
            headers = F.transform(F.array_distinct(names), lambda n: F.struct(F.lit("header_footer").alias("kind"), n.alias("pattern"), F.size(F.filter(names, lambda m: m == n)).alias("count")))
            return F.concat(lines, headers)

        return let(_often(stripped, more_than), of)

    return let(F.transform(F.split(text, "\n", -1), strip), counted)


def clipped(counts: Column) -> Column:
    """Counts by name: kind and the first 20 characters of the pattern. Names that are the same keep the last count."""
    entries = F.transform(counts, lambda c: F.struct(F.concat(c["kind"], F.lit("_"), F.substring(c["pattern"].cast("string"), 1, 20), F.lit("...")).alias("key"), c["count"].alias("value")))
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda o: o["key"] == e["key"]))
    return F.map_from_entries(last)


def normalize_whitespace(text: Column) -> Column:
    """Runs of blanks to one, runs of blank lines to one, no blanks at line ends or text ends."""
    text = F.regexp_replace(text, r"[ \t]+", " ")
    text = F.regexp_replace(text, rf"{U}\n\s*\n\s*\n+", "\n\n")
    return strip(F.regexp_replace(text, r"(?Udm)[^\S\n]+$", ""))


def clean(text: Column, organisation: config.Organisation = config.Organisation()) -> Column:
    """The full cleaner; null and empty give an empty text."""
    out = normalize_whitespace(remove_noise(remove_headers_footers(remove_disclaimers(text, organisation))))
    return F.when(text.isNull() | (text == ""), "").otherwise(out)


def clean_fast(text: Column, organisation: config.Organisation = config.Organisation()) -> Column:
    """The common notices and white space only."""
    out = F.regexp_replace(text, F.lit(f"(?Udis){organisation.fast()}"), F.lit(""))
    out = F.regexp_replace(F.regexp_replace(out, rf"{U}\n\s*\n\s*\n+", "\n\n"), r"[ \t]+", " ")
    return F.when(text.isNull() | (text == ""), "").otherwise(strip(out))


def cleaning_stats(text: Column, cleaned: Column) -> Column:
    """(original_length, cleaned_length, reduction_ratio, excessive): lengths 0 for an empty text."""
    o, c = F.coalesce(F.char_length(text), F.lit(0)), F.char_length(cleaned)
    return F.struct(
        o.alias("original_length"), c.alias("cleaned_length"), ((o - c) / F.greatest(o, F.lit(1))).alias("reduction_ratio"), (c < 0.3 * o).alias("excessive")
    )


def validate_cleaning(text: Column, cleaned: Column) -> Column:
    """``valid``, or the first reason why too much was removed."""
    words, left = F.size(split_words(text)), F.size(split_words(cleaned))
    return (
        F.when(F.coalesce(text, F.lit("")) == "", "valid")
        .when(left / F.greatest(words, F.lit(1)) < 0.3, "word_loss")
        .when(F.char_length(cleaned) / F.char_length(text) < 0.2, "char_loss")
        .when(left < 10, "too_short")
        .otherwise("valid")
    )


def ngrams(text: Column, low: int = 2, high: int = 5, shortest: int = 10, longest: int = 100) -> Column:
    """Runs of ``low`` to ``high`` words joined by a space, of ``shortest`` to ``longest`` characters."""

    def of(words: Column) -> Column:
        def of_length(n: int) -> Column:
            starts = F.sequence(F.lit(1), F.size(words) - n + 1)
            return F.when(F.size(words) >= n, F.transform(starts, lambda i: F.array_join(F.slice(words, i, F.lit(n)), " ")))

        runs = [of_length(n) for n in range(low, high + 1)]
        return F.filter(F.flatten(F.array_compact(F.array(*runs))), lambda g: F.char_length(g).between(shortest, longest))

    return let(split_words(text), of)


def frequent_noise(counts: DataFrame, documents: int, share: float = config.NOISE_THRESHOLD, by: str = "occurrences") -> DataFrame:
    """Phrases that occur at least ``share`` times as often as there are documents (rounded down), the most common first.
    A share of 0 is the default share; ``by`` counts occurrences or documents."""
    least = int(documents * (share or config.NOISE_THRESHOLD))
    return counts.where(F.col(by) >= least).orderBy(F.desc(by), "phrase")
