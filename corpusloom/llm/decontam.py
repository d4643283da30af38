"""Benchmark decontamination by an FM-index over each training shard.

A shard is what one task has read up to a number of words. Its words are numbered by the vocabulary of the benchmark;
words that no phrase has can't be part of a match, so each run of them is one separator, and runs between separators
that are shorter than the shortest phrase are left out. Every phrase is then searched for backward, its occurrences
are located through sampled suffix positions, and their spans are merged by document.

A benchmark of any size is read and sent to the workers in blocks of phrases; a shard is indexed and searched once for
each block, and the spans of all blocks are merged.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import Batches, small_batches, steady
from corpusloom.llm.suffix import FMIndex

WINDOW = 10
#: Bytes of text that a task collects before it indexes and searches them.
SHARD_BYTES = 16 << 20
#: Phrases (windows of items) of a block, of which the driver and a worker hold one at a time.
BLOCK_PHRASES = 500_000

_KEEP = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_MARK = b"|"  # no word has it


def phrase_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words of ASCII letters, digits and all characters beyond ASCII."""
    return text.encode("utf-8", "replace").translate(_KEEP).split() if text else []


def word_spans(text: str) -> list[tuple[int, int]]:
    """Where the words of a text begin and end, in code points."""
    return [m.span() for m in _WORD.finditer(text)]


def cut_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """A text without the words of the spans [first, last + 1) and what lies between them."""
    at, out, end = word_spans(text), [], 0
    for a, b in spans:
        out.append(text[end : at[a][0]])
        end = at[b - 1][1]
    return "".join([*out, text[end:]])


class Phrases:
    """The windows of some items: vocabulary, windows by length, and which items have each window."""

    def __init__(self, owners: dict[tuple[bytes, ...], set[str]]):
        self.vocabulary: dict[bytes, int] = {}
        number = lambda w: self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        found = {tuple(map(number, w)): items for w, items in owners.items()}
        self.windows: dict[int, np.ndarray] = {}
        self.items: dict[int, list[list[str]]] = {}
        for n in sorted({len(w) for w in found}):
            own = sorted(w for w in found if len(w) == n)
            self.windows[n] = np.array(own, dtype=np.int64)
            self.items[n] = [sorted(found[w]) for w in own]


def phrase_blocks(items: Iterable[tuple[str, str | None]], window: int, most: int) -> Iterator[Phrases]:
    """The windows of all items, in blocks of ``most``; the items are read one by one."""
    owners: dict[tuple[bytes, ...], set[str]] = {}
    for item, text in items:
        w = phrase_words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            owners.setdefault(tuple(w[i : i + n]), set()).add(item)
            if len(owners) >= most:
                yield Phrases(owners)
                owners = {}
    if owners:
        yield Phrases(owners)


class Shard:
    """The words of some documents, searched for every block of phrases."""

    def __init__(self) -> None:
        self.parts: list[tuple[bytes, int]] = []
        self.size = 0

    def add(self, texts: list[str | None]) -> None:
        data = b" | ".join([*((t or "").encode("utf-8", "replace").translate(_KEEP) for t in texts), b""])
        self.parts.append((data, len(texts)))
        self.size += len(data)

    def _symbols(self, phrases: Phrases) -> tuple[np.ndarray, list[np.ndarray]]:
        """(symbol, document, position) of what can be part of a match, and the number of words of each document."""
        number = phrases.vocabulary | {_MARK: -1}
        shortest = max(1, min(phrases.windows, default=0))
        symbols, words, docs = [np.zeros((3, 0), np.int64)], [], 0
        for data, n_texts in self.parts:
            w = data.split()
            s = np.fromiter(map(number.get, w, itertools.repeat(0)), dtype=np.int32, count=len(w))
            ends = np.flatnonzero(s == -1)
            starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
            words.append(ends - starts)
            hit = s > 0
            edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
            a, b = edge[::2], edge[1::2]  # runs of known words
            long = b - a >= shortest
            keep = np.zeros(len(s) + 1, dtype=np.int32)
            np.add.at(keep, a[long], 1)
            np.add.at(keep, np.minimum(b[long] + 1, len(s)), -1)  # with the separator after each
            kept = np.flatnonzero(np.cumsum(keep[:-1]) > 0)
            doc = np.searchsorted(ends, kept)
            symbols.append(np.stack([np.maximum(s[kept], 0), doc + docs, kept - starts[doc]]) if len(kept) else symbols[0])
            docs += n_texts
        return np.concatenate(symbols, axis=1), words

    def search(self, blocks: Iterable[Phrases]) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[list[str]]]:
        """For each document: its number of words, its merged hit spans in words, its items."""
        docs = sum(n for _, n in self.parts)
        spans: list[list[tuple[int, int]]] = [[] for _ in range(docs)]
        items: list[set[str]] = [set() for _ in range(docs)]
        n_words = None
        for phrases in blocks:
            (s, doc, pos), words = self._symbols(phrases)
            n_words = np.concatenate(words) if words else np.zeros(0, np.int64)
            if not len(s):
                continue
            index = FMIndex(s.astype(np.int64), len(phrases.vocabulary) + 1)
            covered = np.zeros(len(s) + 1, dtype=np.int64)
            for n, windows in phrases.windows.items():
                low, high = index.search(windows)
                count = high - low
                found = np.flatnonzero(count)
                which = np.repeat(found, count[found])
                rows = np.arange(len(which)) - np.repeat(np.cumsum(count[found]) - count[found], count[found]) + low[which]
                at = index.locate(rows)
                np.add.at(covered, at, 1)
                np.add.at(covered, at + n, -1)
                pairs = np.unique(doc[at] * len(windows) + which)
                for p in pairs.tolist():
                    items[p // len(windows)].update(phrases.items[n][p % len(windows)])
            inside = np.cumsum(covered[:-1]) > 0
            turn = np.flatnonzero(np.diff(np.concatenate([[0], inside.astype(np.int8), [0]])))
            for a, b in zip(turn[::2].tolist(), turn[1::2].tolist(), strict=True):
                # windows of neighbouring runs never touch: a separator lies between them
                spans[doc[a]].append((int(pos[a]), int(pos[b - 1]) + 1))
        if n_words is None:  # no phrase at all
            n_words = np.concatenate([np.zeros(0, np.int64), *self._symbols(Phrases({}))[1]])
        return n_words, [merged(x) for x in spans], [sorted(x) for x in items]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch or overlap joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def find_leaks(documents: DataFrame, benchmark: DataFrame, text: Column | str, keep: list[Column | str], item: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """The columns ``keep`` of every document with ``n_words``, ``spans`` (words, end exclusive), ``items``; ``text`` is
    a column, or the name of one of ``keep``, which then goes to the workers once.

    An item's windows are its runs of ``window`` words; an item of fewer words, but not none, is one window. Null and
    empty texts have no words on either side. ``items`` are item ids as strings, sorted; repeated item ids count once,
    a null id is the empty string. Any order and repetition of rows is allowed; empty tables give what they imply.
    Further columns of any name are allowed on both sides; a very long text is searched whole. The driver reads the
    benchmark row by row and holds a block of ``BLOCK_PHRASES`` windows at a time, and so does a worker.
    """
    spark = documents.sparkSession
    small_batches(spark)
    rows = benchmark.select(F.coalesce(F.col(f"`{item}`").cast("string"), F.lit("")), F.col(f"`{item_text}`").cast("string")).toLocalIterator()
    shared = [spark.sparkContext.broadcast(vars(b)) for b in phrase_blocks(((r[0], r[1]) for r in rows), window, BLOCK_PHRASES)]
    most = SHARD_BYTES
    own = isinstance(text, str)
    thin = documents.select(*keep) if own else documents.select(*keep, text.cast("string").alias("__text"))
    kept = thin.columns if own else thin.columns[:-1]
    at = kept.index(text) if own else len(kept)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in thin.schema.fields[: len(kept)])
    extra = pa.schema([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("items", pa.list_(pa.string()))])

    def blocks() -> Iterator[Phrases]:
        for one in shared:
            phrases = Phrases({})
            vars(phrases).update(one.value)
            yield phrases
            if len(shared) > 1:
                vars(one).pop("_value", None)  # read again for the next shard

    @steady
    def run(batches: Batches) -> Batches:
        shard, waiting = Shard(), []

        def flush() -> Batches:
            n_words, spans, items = shard.search(blocks())
            a = 0
            for w in waiting:
                b = a + w.num_rows
                found = [
                    pa.array(n_words[a:b], pa.int64()),
                    pa.array([[{"start": x, "end": y} for x, y in s] for s in spans[a:b]], extra.field("spans").type),
                    pa.array(items[a:b], extra.field("items").type),
                ]
                yield pa.RecordBatch.from_arrays([*w.columns, *found], names=[*kept, *extra.names])
                a = b

        for b in batches:
            shard.add(b.column(at).to_pylist())
            waiting.append(b.select(kept))
            if shard.size >= most:
                yield from flush()
                shard, waiting = Shard(), []
        if waiting:
            yield from flush()

    return thin.mapInArrow(run, schema + "n_words long, spans array<struct<start:int,end:int>>, items array<string>")


def digest(items: list[str]) -> str:
    """Hex SHA-256 of item ids joined by commas."""
    return hashlib.sha256(",".join(items).encode()).hexdigest()
