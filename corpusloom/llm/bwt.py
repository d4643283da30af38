"""Suffix-array dedup over bytes by merging Burrows-Wheeler transforms.

Shards of segments are each sorted once. Their transforms are merged by refining an interleave of the two, which is
known by its cuts: a cut says how many rows of each shard stand before it, and parts rows that differ. The first cuts
stand between first symbols. A round takes the cuts that the round before has found and carries them one symbol to the
left, by the ranks of that symbol in both transforms; the cuts that are new part rows with a common prefix one symbol
longer. Only what has just been parted is looked at again, so the rounds together cost about one look at each row and
symbol. Rows without a cut between them after as many rounds as a window is long are a repeated interval. No suffix is
sorted again.
"""

from __future__ import annotations

import hashlib
import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusloom.llm.common import Batches, steady
from corpusloom.llm.repeats import Segment, by_row, covered, distinct_texts, find_repeats, levels
from corpusloom.llm.suffix import suffix_array
from corpusloom.session import Scratch

#: Bytes of the sampled runs of the first level.
GRAM = 32
#: Bytes of a shard that is sorted; more shards are merged two by two.
SHARD_BYTES = 128 << 10


@dataclass(frozen=True)
class Transform:
    """Rows of a collection of strings in suffix order: preceding symbol and position; ends sort below any byte, and
    among themselves in the order of their strings."""

    before: np.ndarray
    position: np.ndarray
    strings: int


def transform(text: np.ndarray, base: int = 0) -> Transform:
    """Sort a shard: ``text`` holds the strings one after another, each byte plus 1, each string ended by 0."""
    ends = np.flatnonzero(text == 0)
    rows = suffix_array(text, 257)
    rows = np.concatenate([ends, rows[text[rows] != 0]])
    return Transform(np.where(rows > 0, text[np.maximum(rows - 1, 0)], 0).astype(np.uint16), rows + base, len(ends))


class Ranks:
    """How many rows before any row are preceded by a symbol, and which row that leads to."""

    def __init__(self, t: Transform, used: np.ndarray, code: np.ndarray):
        self.rows = code[t.before]
        width = len(t.before) // 64 + 1
        bits = np.zeros((len(used), width * 8), dtype=np.uint8)
        for c in range(len(used)):
            packed = np.packbits(self.rows == c, bitorder="little")
            bits[c, : len(packed)] = packed
        self.words, self.width = bits.view("<u8"), width
        counts = np.cumsum(np.bitwise_count(self.words), axis=1, dtype=np.int32)
        total = counts[:, -1].astype(np.int64)
        self.first = np.where(used > 0, t.strings + np.cumsum(total * (used > 0)) - total, 0)
        self.before = np.zeros_like(counts)
        self.before[:, 1:] = counts[:, :-1]
        self.words, self.before = self.words.reshape(-1), self.before.reshape(-1)

    def step(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """The cut before row ``i``, carried to the left by the symbol of code ``c``."""
        w = c * self.width + (i >> 6)
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.first[c] + self.before[w] + np.bitwise_count(self.words[w] & low)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after another."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()), dtype=np.int64)


def merge(a: Transform, b: Transform, depth: int | None = None) -> tuple[Transform, np.ndarray]:
    """The transform of two shards together, and each row's common prefix with the row above, known up to ``depth``.

    Without a depth, rounds go on until no two rows are left to part: only then are rows in the order that a further
    merge needs. With one, rows with as long a common prefix stay in the order of their shards.
    """
    n, ends = len(a.before) + len(b.before), a.strings + b.strings
    counts = np.bincount(a.before, minlength=257) + np.bincount(b.before, minlength=257)
    used = np.flatnonzero(counts)
    code = np.zeros(257, dtype=np.int64)
    code[used] = np.arange(len(used))
    ra, rb = Ranks(a, used, code), Ranks(b, used, code)
    letters = np.flatnonzero(used)  # codes of symbols other than an end
    most = depth if depth is not None else n + 1
    lcp = np.full(n + 1, most, dtype=np.int32)
    cut = np.zeros(n + 1, dtype=bool)
    left = np.zeros(n + 1, dtype=np.int64)  # rows of ``a`` before a cut
    # every end is a symbol of its own, those of ``a`` before those of ``b``; then the first rows of each symbol
    at = np.concatenate([np.arange(ends + 1), ra.first[letters] + rb.first[letters], [n]])
    left[at] = np.concatenate([np.minimum(np.arange(ends + 1), a.strings), ra.first[letters], [len(a.before)]])
    cut[at], lcp[at] = True, 0
    new = np.unique(at[at > 0])
    for k in range(1, most):
        # what a new cut ends: the rows down from the cut before it, looked for as far as it has symbols
        size, open_ = np.zeros(len(new), dtype=np.int64), np.arange(len(new))
        for d in range(1, len(letters) + 1):
            stop = cut[new[open_] - d]
            size[open_[stop]] = d
            open_ = open_[~stop]
            if not len(open_):
                break
        few = np.flatnonzero(size)
        high, m = new[few], size[few]
        low = high - m
        own_a, own_b = left[high] - left[low], m - left[high] + left[low]
        symbols = np.concatenate([ra.rows[_ranges(left[low], own_a)], rb.rows[_ranges(low - left[low], own_b)], np.tile(letters, len(open_))])
        source = np.concatenate([np.repeat(high, own_a), np.repeat(high, own_b), np.repeat(new[open_], len(letters))])
        real = used[symbols] > 0  # the rows before an end lead to no suffix
        symbols, source = symbols[real], source[real]
        i, j = ra.step(symbols, left[source]), rb.step(symbols, source - left[source])
        fresh = ~cut[i + j]
        i, j = i[fresh], j[fresh]
        if not len(i):
            break  # nothing parts any more
        new, which = np.unique(i + j, return_index=True)
        left[new], cut[new], lcp[new] = i[which], True, k
    cuts = np.flatnonzero(cut)
    of_a, of_b = np.diff(left[cuts]), np.diff(cuts - left[cuts])
    position, before = np.empty(n, dtype=np.int64), np.empty(n, dtype=a.before.dtype)
    for rows, t in ((_ranges(cuts[:-1], of_a), a), (_ranges(cuts[:-1] + of_a, of_b), b)):
        position[rows], before[rows] = t.position, t.before
    return Transform(before, position, ends), lcp[:n]


def _common(a: bytes, b: bytes) -> int:
    """The length of the common prefix."""
    n = min(len(a), len(b))
    a, b = a[:n], b[:n]
    if a == b:
        return n
    return n - ((int.from_bytes(a) ^ int.from_bytes(b)).bit_length() + 7) // 8


def _reach(sides: list[bytes], many: list[bool]) -> list[int]:
    """For each string the longest prefix that it shares with another one, or all of it if it stands for several."""
    order = sorted(range(len(sides)), key=sides.__getitem__)
    out = [len(s) if m else 0 for s, m in zip(sides, many, strict=True)]
    for i, j in itertools.pairwise(order):
        if not (many[i] and many[j]):
            n = _common(sides[i], sides[j])
            out[i], out[j] = max(out[i], n), max(out[j], n)
    return out


def trimmed(group: list[Segment], window: int) -> list[tuple[int, bytes]]:
    """What of each segment can repeat: where it begins, and its bytes (none if it is shorter than a window).

    All windows of a group have the sampled run, so equal ones agree to its left and to its right: no farther on either
    side than the segment agrees with any other there.
    """
    many = [r[2] > 1 for r in group]
    right = _reach([r[3][r[5] :] for r in group], many)
    left = _reach([r[3][: r[5]][::-1] for r in group], many)
    return [(r[5] - x, r[3][r[5] - x : r[5] + y] if x + y >= window else b"") for r, x, y in zip(group, left, right, strict=True)]


def merging(window: int, shard_bytes: int = SHARD_BYTES):
    """A matcher over bytes: shards of the segments, sorted each and merged two by two. Rows whose common prefix is a
    window or longer make an interval; its windows repeat if it stands for more than one place.

    A content that occurs at several places is one string with that number, so a row of it stands for as many. Groups
    of which that already says everything (each content at several places, or one content alone) are not sorted, and
    segments are cut to what can repeat before (``trimmed``).
    """

    def match(rows: list[Segment]) -> list[np.ndarray]:
        out = [np.full(r[4], r[2] > 1, dtype=bool) for r in rows]
        strings: list[tuple[bytes, list[tuple[int, int]]]] = []  # a content, and the segments and places that it has
        at = 0
        for _, some in itertools.groupby(rows, key=lambda r: r[0]):
            group = list(some)
            if len(group) > 1 and any(r[2] == 1 for r in group):
                places: dict[bytes, list[tuple[int, int]]] = {}
                number: dict[bytes, int] = {}
                for i, (r, (begin, body)) in enumerate(zip(group, trimmed(group, window), strict=True)):
                    if body:
                        places.setdefault(body, []).append((at + i, begin))
                        number[body] = number.get(body, 0) + r[2]
                for body, own in places.items():
                    if number[body] > 1:
                        for i, begin in own:
                            out[i][begin : begin + len(body) - window + 1] = True
                if len(places) > 1 and any(n == 1 for n in number.values()):
                    strings += places.items()
            at += len(group)
        if len(strings) < 2:
            return out
        total = sum(len(s) + 1 for s, _ in strings)
        shards = min(len(strings), max(2, -(-total // shard_bytes)))
        sorted_, begins, base = [], [], 0
        for part in (strings[j::shards] for j in range(shards)):
            sorted_.append(transform(np.concatenate([np.append(np.frombuffer(s, dtype=np.uint8).astype(np.int32) + 1, 0) for s, _ in part]), base))
            for s, own in part:
                begins.append((base, len(s) - window + 1, own))
                base += len(s) + 1
        while len(sorted_) > 2:
            sorted_ = [merge(*sorted_[j : j + 2])[0] if j + 1 < len(sorted_) else sorted_[j] for j in range(0, len(sorted_), 2)]
        merged, lcp = merge(*sorted_, window)
        same = lcp >= window
        again = np.zeros(base, dtype=bool)
        again[merged.position[same | np.append(same[1:], False)]] = True
        for place, n, own in begins:
            for i, begin in own:
                out[i][begin : begin + n] |= again[place : place + n]
        return out

    return match


def remove_repeats(documents: DataFrame, text: str = "text", key: str = "doc_id", window: int = 200, with_text: bool = True) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``spans`` (start, end), ``kept`` (binary, if ``with_text``) and
    ``kept_sha256`` of every row.

    A byte goes if a string of ``window`` bytes that covers it also starts anywhere else, the same document included;
    repeated rows are different documents. ``spans`` are the maximal removed runs. Null texts count as empty; texts
    shorter than a window lose nothing; very long texts go in blocks of windows. Null and repeated keys are allowed,
    and so are further columns of any name. An empty table gives an empty result.
    """
    scratch = Scratch(documents.sparkSession)
    distinct = distinct_texts(documents, text, scratch)
    found = find_repeats(distinct, "bytes", window, levels(GRAM, window), merging(window), scratch)
    joined = distinct.join(found.hint("shuffle_hash"), "tid", "left").select("tid", "copies", "text", "found")
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    @steady
    def finish(batches: Batches) -> Batches:
        for b in batches:
            texts = [t.encode("utf-8", "replace") for t in b.column(2).to_pylist()]
            n = np.array([len(t) for t in texts], dtype=np.int64)
            gone, begins = covered(b.column(3), n, b.column(1).to_numpy(), window)
            turn = np.flatnonzero(np.diff(gone, prepend=False, append=False))  # in and out of runs, never over a text's end
            own = np.searchsorted(turn, np.append(begins, len(gone)))
            removed, spans, kept = [], [], []
            for raw, a, lo, hi in zip(texts, begins.tolist(), own[:-1].tolist(), own[1:].tolist(), strict=True):
                edges = [x - a for x in turn[lo:hi].tolist()]
                starts, ends = edges[::2], edges[1::2]
                removed.append(sum(ends) - sum(starts))
                spans.append([{"start": x, "end": y} for x, y in zip(starts, ends, strict=True)])
                kept.append(b"".join(raw[x:y] for x, y in zip([0, *ends], [*starts, len(raw)], strict=True)) if edges else raw)
            sha = [hashlib.sha256(k).hexdigest() for k in kept]
            arrays = [b.column(0), pa.array(n), pa.array(removed, pa.int64()), pa.array(spans, span), pa.array(sha)]
            names = ["tid", "n_bytes", "n_removed", "spans", "kept_sha256"]
            if with_text:
                arrays, names = [*arrays, pa.array(kept, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "tid binary, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string" + ", kept binary" * with_text
    results = scratch.table(joined.mapInArrow(finish, schema), "results")
    scratch.drop(distinct, found)
    return by_row(documents, text, key, results)
