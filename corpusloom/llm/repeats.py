"""Finding every window of a fixed length that occurs more than once, over words or bytes, without comparing pairs.

1. Equal texts are one text with a number of copies: a text that a third of all rows share is worked on once.
2. Every window samples one short run of units inside it: the one with the least hash. Equal windows sample the same
   run at the same offset, so a window can only repeat if its sampled run does. Runs are counted by hash; those that
   occur once end here, which leaves about the repeated share of the corpus.
3. Neighbouring windows that sample the same run make a segment. Segments with equal content are counted together and
   known by 128 bits of BLAKE2 of their content; hashes of runs only propose, and never decide.
4. Segments that sample equal runs meet in one task, where a *matcher* decides window by window which repeat: by
   level-wise doubling (``substring``) or by merging Burrows-Wheeler transforms (``bwt``).
5. A group of segments too large for a task (very many contexts share a run) goes to the next level as a table: its
   segments are sampled again by runs of twice the length, counted over all groups, and those that still repeat are
   grouped anew. At the last level a run is a whole window, so a group is one content and any size is counted.
6. What repeats goes back, level by level, to the texts that have the segments, and from there to the rows.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import Batches, small_batches, steady
from corpusloom.session import Scratch, release

#: Windows worked on at once within one text; a longer text goes in blocks, each with the units its windows need.
BLOCK = 1 << 16
_POSITION = np.uint64(17)
#: Bytes of segments that a task gathers before it matches them.
MATCH_BYTES = 1 << 20
#: Bytes of one group from which it goes to the next level.
GROUP_BYTES = 8 << 20

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_U = np.uint64
_LOW = 1 << 16


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    at = 1
    while at < n:
        k = min(at, n - at)
        out[at : at + k] = out[:k] * _U(pow(base, at, 1 << 64))
        at += k
    return out


def _table(base: int) -> np.ndarray:
    """The first powers of a base; higher ones are products of two numbers, so no table grows with the data. Functions
    travel by value, so a process keeps the table where every copy of this function finds it."""
    kept = vars(sys).setdefault("_corpusloom_powers", {})
    if base not in kept:
        kept[base] = _powers(base, _LOW)
    return kept[base]


def _power_range(base: int, n: int) -> np.ndarray:
    low = _table(base)
    if n <= _LOW:
        return low[:n]
    return np.outer(_powers(pow(base, _LOW, 1 << 64), -(-n // _LOW)), low).reshape(-1)[:n]


def _powers_at(base: int, at: np.ndarray, n: int) -> np.ndarray:
    low = _table(base)
    if n <= _LOW:
        return low[at]
    return low[at & (_LOW - 1)] * _powers(pow(base, _LOW, 1 << 64), -(-n // _LOW))[at >> 16]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Hasher:
    """Hashes of any byte ranges of some bytes: polynomials modulo 2**64, from prefix sums."""

    def __init__(self, data: np.ndarray, lane: int = 0):
        self.base, self.size = pow(_BASES[lane], -1, 1 << 64), len(data) + 1
        self.sums = np.zeros(self.size, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + _U(1)) * _power_range(_BASES[lane], len(data)), dtype=np.uint64, out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * _powers_at(self.base, start, self.size) + (end - start).astype(np.uint64))


def split_units(text: str | bytes | None, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of a text and where its units begin and end: its words, one space between them, or its bytes."""
    raw = text if isinstance(text, bytes) else (text or "").encode("utf-8", "replace")
    if kind == "words":
        raw = b" ".join(raw.split())  # splits at the six ASCII white-space bytes
        data = np.frombuffer(raw, dtype=np.uint8)
        if not len(data):
            return data, np.zeros(0, np.int64), np.zeros(0, np.int64)
        gaps = np.flatnonzero(data == 32)
        return data, np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(data)]])
    data = np.frombuffer(raw, dtype=np.uint8)
    at = np.arange(len(data), dtype=np.int64)
    return data, at, at + 1


#: A piece of a text: the text's number, its first window, its bytes, and where its units begin and end.
Piece = tuple[int, int, np.ndarray, np.ndarray, np.ndarray]


def pieces(units: Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]], window: int) -> Iterator[list[Piece]]:
    """The texts (see ``split_units``) that have a window, many short ones together, a long one in blocks of windows."""
    waiting: list[Piece] = []
    size = 0
    for i, (data, start, end) in enumerate(units):
        n = len(start) - window + 1
        if n > BLOCK:
            for a in range(0, n, BLOCK):
                b = min(n, a + BLOCK) + window - 1
                lo, hi = int(start[a]), int(end[b - 1])
                yield [(i, a, data[lo:hi], start[a:b] - lo, end[a:b] - lo)]
        elif n > 0:
            waiting.append((i, 0, data, start, end))
            size += len(start)
            if size >= BLOCK // 2:
                yield waiting
                waiting, size = [], 0
    if waiting:
        yield waiting


@dataclass(frozen=True)
class Runs:
    """Segments of some pieces: text, first window, number of windows, sampled hash, where the sampled run begins after
    the first window (in units), and the range in ``data``."""

    data: np.ndarray
    text: np.ndarray
    first: np.ndarray
    n: np.ndarray
    hashes: np.ndarray
    run: np.ndarray
    begin: np.ndarray
    stop: np.ndarray

    def where(self, own: np.ndarray) -> Runs:
        return Runs(self.data, *(x[own] for x in (self.text, self.first, self.n, self.hashes, self.run, self.begin, self.stop)))


def runs(some: list[Piece], window: int, gram: int) -> Runs:
    """Neighbouring windows of one text that sample the same run of ``gram`` units, the one of least hash, as segments."""
    sizes = np.array([len(x[3]) for x in some])
    shift = np.repeat(np.cumsum([0, *(len(x[2]) for x in some[:-1])]), sizes)
    data = np.concatenate([x[2] for x in some])
    start, end = np.concatenate([x[3] for x in some]) + shift, np.concatenate([x[4] for x in some]) + shift
    g = Hasher(data).of(start[: len(start) - gram + 1], end[gram - 1 :])
    packed = ((g >> _POSITION) << _POSITION) | np.arange(len(g), dtype=np.uint64)
    width, step = window - gram + 1, 1
    while step * 2 <= width:
        packed = np.minimum(packed[:-step], packed[step:])
        step *= 2
    if step < width:
        packed = np.minimum(packed[: len(packed) - (width - step)], packed[width - step :])
    spot = (packed & _U((1 << 17) - 1)).astype(np.int64)
    own = np.repeat(np.arange(len(some)), sizes)
    begins = np.cumsum(sizes) - sizes
    inside = np.arange(len(spot)) + window <= (begins + sizes)[own[: len(spot)]]  # others run into the next text
    at = np.flatnonzero(inside)
    edge = np.flatnonzero((np.diff(spot[at]) != 0) | (np.diff(own[at]) != 0)) + 1
    first, last = at[np.concatenate([[0], edge])], at[np.concatenate([edge, [len(at)]]) - 1]
    piece = own[first]
    text, offset = np.array([x[0] for x in some])[piece], np.array([x[1] for x in some])[piece] - begins[piece]
    return Runs(data, text, first + offset, last - first + 1, g[spot[first]], spot[first] - first, start[first], end[last + window - 1])


def levels(first: int, window: int) -> list[int]:
    """Lengths of runs: ``first``, twice as many units each time, and last a whole window."""
    out = [min(first, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


def text_id(text: Column) -> Column:
    """16 bytes that stand for a text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit(""))))


def distinct_texts(documents: DataFrame, text: str, scratch: Scratch) -> DataFrame:
    """``tid``, ``copies`` and ``text`` of each distinct text, in buckets of ``tid``."""
    rows = documents.select(text_id(F.col(f"`{text}`")).alias("tid"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    out = scratch.bucketed(rows.groupBy("tid").agg(F.count("*").alias("copies"), F.first("text").alias("text")), "texts", "tid")
    release(scratch.spark)
    return out


#: Gets segments as (sampled hash, id, occurrences, bytes, windows, place of the run), whole groups of equal sampled hash
#: one after another; returns for each a boolean for each window.
Segment = tuple[int, bytes, int, bytes, int, int]
Matcher = Callable[[list[Segment]], list[np.ndarray]]
_SEGMENT = "h long, sid binary, {key}, first int, n int, run int, m long, body binary"


def _bodies(r: Runs) -> tuple[list[bytes], list[bytes]]:
    """Ids and bytes of segments."""
    raw = r.data.tobytes()
    bodies = [raw[x:y] for x, y in zip(r.begin.tolist(), r.stop.tolist(), strict=True)]
    return [hashlib.blake2b(x, digest_size=16).digest() for x in bodies], bodies


def _batch(r: Runs, keys: dict[str, pa.Array], m: np.ndarray, sids: list[bytes], bodies: list[bytes | None]) -> pa.RecordBatch:
    text = pa.array(r.text)
    cols = {"h": pa.array(r.hashes.view(np.int64)), "sid": pa.array(sids, pa.binary())} | {k: v.take(text) for k, v in keys.items()}
    cols |= {"first": pa.array(r.first.astype(np.int32)), "n": pa.array(r.n.astype(np.int32)), "run": pa.array(r.run.astype(np.int32)), "m": pa.array(m[r.text], pa.int64()), "body": pa.array(bodies, pa.binary())}
    return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))


def find_repeats(texts: DataFrame, kind: str, window: int, grams: Sequence[int], matcher: Matcher, scratch: Scratch) -> DataFrame:
    """``tid`` and ``found`` (see ``covered``): the repeated windows of distinct ``texts``.

    ``texts`` are ``tid``, ``copies``, ``text``. A segment occurs as often as its texts have copies; those of a text with
    copies repeat in any case, but go on only where another text may share them. ``grams`` are the lengths of sampled runs by level (see ``levels``).
    """
    small_batches(scratch.spark)

    @steady
    def sample(batches: Batches) -> Batches:
        for b in batches:
            for some in pieces((split_units(t, kind) for t in b.column(1).to_pylist()), window):
                r = runs(some, window, grams[0])
                yield pa.RecordBatch.from_arrays([pa.array(r.hashes.view(np.int64)), b.column(0).take(pa.array(r.text)), pa.array(r.first.astype(np.int32))], names=["h", "tid", "first"])

    sampled = scratch.table(texts.select("tid", "text").mapInArrow(sample, "h long, tid binary, first int"), "sampled")
    # a table of its own, so that a hash that very many rows share can be split in the join
    again = scratch.table(sampled.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "again")
    release(scratch.spark)
    hits = scratch.table(sampled.join(again, "h", "left_semi").groupBy("tid").agg(F.collect_list("first").alias("firsts")), "hits")
    scratch.drop(sampled, again)

    @steady
    def cut(batches: Batches) -> Batches:
        sent: set[bytes] = set()  # the body goes once for each id and task, or a few times
        for b in batches:
            copies = b.column(1).to_numpy()
            lists = b.column(3)
            wanted = np.repeat(np.arange(b.num_rows) << 32, np.diff(lists.offsets.to_numpy())) + lists.flatten().to_numpy()
            for some in pieces((split_units(t, kind) for t in b.column(2).to_pylist()), window):
                r = runs(some, window, grams[0])
                r = r.where(np.isin((r.text << 32) + r.first, wanted))
                sids, bodies = _bodies(r)
                new = [body if sid not in sent else None for sid, body in zip(sids, bodies, strict=True)]
                sent.update(sids)
                yield _batch(r, {"tid": b.column(0)}, copies, sids, new)
            if len(sent) > 100_000:
                sent.clear()

    cutting = texts.join(hits.hint("shuffle_hash"), "tid").select("tid", "copies", "text", "firsts").mapInArrow(cut, _SEGMENT.format(key="tid binary"))
    segments = scratch.table(cutting, "segments")
    scratch.drop(hits)
    counted = segments.groupBy("h", "sid").agg(F.sum("m").alias("m"), F.max("n").alias("n"), F.max("run").alias("run"), F.max("body").alias("body"))
    counted = scratch.table(counted.select("h", "sid", "m", "body", "n", "run"), "counted")
    release(scratch.spark)
    marked = _settled(counted, kind, window, grams, 0, matcher, scratch)
    found = segments.select("h", "sid", "tid", "first").join(marked, ["h", "sid"])
    lists = found.groupBy("tid").agg(F.collect_list(F.struct((F.col("first") + F.col("at")).alias("first"), "n", "bits")).alias("found"))
    out = scratch.table(lists, "found")
    scratch.drop(segments, marked)
    return out


def _settled(segments: DataFrame, kind: str, window: int, grams: Sequence[int], level: int, matcher: Matcher, scratch: Scratch) -> DataFrame:
    """``h``, ``sid``, ``at``, ``n``, ``bits``: which of the ``n`` windows from ``at`` on of each segment repeat.

    ``segments`` are distinct: ``h``, ``sid``, ``m`` (occurrences), ``body``, ``n``, ``run``; the table is dropped.
    """
    small, large = segments, None
    if level + 1 < len(grams):
        large = scratch.table(segments.groupBy("h").agg(F.sum(F.octet_length("body")).alias("size")).where(F.col("size") > GROUP_BYTES).select("h"), "large")
        if large.limit(1).count():
            small = segments.join(large, "h", "left_anti")
        else:
            scratch.drop(large)
            large = None
    group_bytes = MATCH_BYTES

    @steady
    def match(batches: Batches) -> Batches:
        waiting: list[tuple] = []
        size = 0

        def flush(rows: list[tuple]) -> pa.RecordBatch:
            keep = [(r[0], r[1], 0, r[4], np.packbits(x, bitorder="little").tobytes()) for r, x in zip(rows, matcher(rows), strict=True) if x.any()]
            cols = list(zip(*keep, strict=True)) or [()] * 5
            types = (pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["h", "sid", "at", "n", "bits"])

        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if size >= group_bytes and r[0] != waiting[-1][0]:
                    yield flush(waiting)
                    waiting, size = [], 0
                waiting.append(r)
                size += len(r[3])
        if waiting:
            yield flush(waiting)

    dealt = small.repartition("h").sortWithinPartitions("h", "sid").select("h", "sid", "m", "body", "n", "run")
    marked = dealt.mapInArrow(match, "h long, sid binary, at int, n int, bits binary")
    if large is None:
        out = scratch.table(marked, "marked")
        scratch.drop(segments)
        return out
    marked = scratch.table(marked, "marked")

    @steady
    def cut(batches: Batches) -> Batches:
        for b in batches:
            for some in pieces((split_units(body, kind) for body in b.column(3).to_pylist()), window):
                r = runs(some, window, grams[level + 1])
                yield _batch(r, {"h0": b.column(0), "sid0": b.column(1)}, b.column(2).to_numpy(), *_bodies(r))

    parts = segments.join(large, "h", "left_semi").select("h", "sid", "m", "body").mapInArrow(cut, _SEGMENT.format(key="h0 long, sid0 binary"))
    parts = scratch.table(parts, "parts")
    scratch.drop(segments, large)
    again = scratch.table(parts.groupBy("h").agg(F.sum("m").alias("m")).where("m > 1").select("h"), "again")
    left = parts.join(again, "h", "left_semi").groupBy("h", "sid").agg(F.sum("m").alias("m"), F.max("n").alias("n"), F.max("run").alias("run"), F.max("body").alias("body"))
    left = scratch.table(left.select("h", "sid", "m", "body", "n", "run"), "counted")
    scratch.drop(again)
    deeper = _settled(left, kind, window, grams, level + 1, matcher, scratch)
    back = parts.select("h", "sid", "h0", "sid0", "first").join(deeper, ["h", "sid"])
    back = back.select(F.col("h0").alias("h"), F.col("sid0").alias("sid"), (F.col("first") + F.col("at")).alias("at"), "n", "bits")
    out = scratch.table(marked.unionByName(back), "marked")
    scratch.drop(parts, deeper, marked)
    return out


def covered(found: pa.ListArray, units: np.ndarray, copies: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Which units of some texts lie in a repeated window, one text after another, and where each text begins; of a
    text with copies every window repeats. ``units`` are the numbers of units, ``found`` comes from ``find_repeats``."""
    begins = np.cumsum(units + 1) - units - 1  # a place after each text, where windows may end
    edge = np.zeros(int((units + 1).sum()) + 1, dtype=np.int32)
    counts = np.asarray(pc.list_value_length(found).fill_null(0))
    rows = pc.list_flatten(found)
    first, n, bits = (rows.field(k) for k in ("first", "n", "bits"))
    if len(rows):
        first, n = first.to_numpy(zero_copy_only=False).astype(np.int64), n.to_numpy(zero_copy_only=False).astype(np.int64)
        all_bits = np.unpackbits(np.frombuffer(b"".join(bits.to_pylist()), dtype=np.uint8), bitorder="little")
        size = np.asarray(pc.binary_length(bits)).astype(np.int64) * 8
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        hit = all_bits[np.repeat(np.cumsum(size) - size, n) + inner] > 0
        starts = (np.repeat(first + np.repeat(begins, counts), n) + inner)[hit]
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + window, -1)
    whole = np.flatnonzero((copies > 1) & (units >= window))
    edge[begins[whole]] += 1
    edge[begins[whole] + units[whole]] -= 1
    return np.cumsum(edge[:-1], dtype=np.int32) > 0, begins


def by_row(documents: DataFrame, text: str, key: str, results: DataFrame) -> DataFrame:
    """The columns of ``results`` (by ``tid``) for each row, after its key as ``doc_id``; only keys and ids are dealt out."""
    rows = documents.select(F.col(f"`{key}`").alias("doc_id"), text_id(F.col(f"`{text}`")).alias("tid"))
    return rows.join(results, "tid").drop("tid")
