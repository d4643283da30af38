"""Exact counts of all runs of two to five words, with a shuffle of about the size of the text.

A map task counts the runs of its own documents and deals them out as packed tries: a run of three words goes to a bucket
by its hash, and what follows it hangs below, so a run of five words costs little more than its last word. Words are
kept whole, in a list for each packed trie; a bucket joins the tries of all tasks. Nothing is sampled, and no run is left out.
"""

from __future__ import annotations

import ctypes
import gc
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that a task counts at once (a document is never parted), and characters of text by bucket.
FLUSH_WORDS, BUCKET_CHARS = 2_000_000, 8_000_000
LOW, HIGH = 2, 5
#: Of the compression of what is dealt out, which is most of the disk that a count takes.
LEVEL = 5
#: What Unicode has as white space; ``str.split`` takes four more characters for it.
_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_MORE = re.compile("[\x1c-\x1f]")
_LOWER = np.int64((1 << 32) - 1)
_KINDS = (np.uint8, np.uint16, np.uint32, np.int64)


def _tidy() -> None:
    """Give back to the system what a bucket or a task has freed: executors have one bound for all."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


class _Names(dict):
    """A number for each word, from 0, in the order in which they are looked up."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def _words(text: str) -> list[str]:
    return [w for w in _SPACE.split(text) if w] if _MORE.search(text) else text.split()


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where a new value begins in an ordered array."""
    return np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct numbers in order, the rank of each number, an order by rank, and where each rank begins in it."""
    order = np.argsort(keys)
    ordered = keys[order]
    starts = _starts(ordered)
    step = np.zeros(len(keys), np.int64)
    step[starts] = 1
    ranks = np.empty(len(keys), np.int64)
    ranks[order] = np.cumsum(step) - 1
    return ordered[starts], ranks, order, starts


def _pack(arrays: list[np.ndarray], words: list[str]) -> bytes:
    """Whole numbers in the fewest bytes, byte by byte, and words."""
    head, body = [len(arrays)], []
    for a in arrays:
        most = int(a.max()) if len(a) else 0
        kind = next(i for i, k in enumerate(_KINDS) if most <= np.iinfo(k).max)
        raw = np.ascontiguousarray(a.astype(_KINDS[kind]))
        head += [kind, len(a)]
        body.append(raw.view(np.uint8).reshape(-1, raw.itemsize).T.tobytes() if len(a) else b"")
    data = np.array(head, np.int64).tobytes() + b"".join(body) + "\n".join(words).encode("utf-8")  # no word has a line end
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=LEVEL).compress(data, asbytes=True)


def _unpack(blob: bytes) -> tuple[list[np.ndarray], list[str]]:
    data = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    head, at, out = np.frombuffer(data, np.int64, 2 * n, 8), 8 + 16 * n, []
    for kind, size in head.reshape(-1, 2).tolist():
        k = np.dtype(_KINDS[kind])
        raw = np.frombuffer(data, np.uint8, size * k.itemsize, at).reshape(k.itemsize, size)
        out.append(np.ascontiguousarray(raw.T).view(k).reshape(-1).astype(np.int64))
        at += size * k.itemsize
    return out, data[at:].decode("utf-8").split("\n")


def _levels(ids: np.ndarray, left: np.ndarray, doc: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For 2 to 5 words: the runs as (rank of the run without its last word, last word), in order; how often each occurs;
    in how many documents. ``left`` is the number of words of the text from a word on."""
    rank, out = ids.astype(np.int64), []
    for n in range(LOW, HIGH + 1):
        at = np.flatnonzero(left >= n)
        runs, own, order, starts = _ranked(rank[at] << 32 | ids[at + n - 1])
        times = np.diff(np.append(starts, len(at)))
        docs = np.ones(len(runs), np.int64)
        again = np.flatnonzero(times[own] > 1)
        pairs = np.sort(own[again] << 32 | doc[at[again]])
        found = pairs[_starts(pairs)] >> 32
        if len(found):
            docs = np.maximum(docs, np.bincount(found, minlength=len(runs)))
        rank = np.zeros(len(ids), np.int64)
        rank[at] = own
        out.append((runs, times, docs))
    return out


def _mix(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    h = (h ^ word) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _dealt(ids: np.ndarray, left: np.ndarray, doc: np.ndarray, words: list[str], buckets: int) -> Iterator[tuple[int, bytes]]:
    """The runs by bucket, packed."""
    levels = _levels(ids, left, doc)
    h = np.array([zlib.crc32(w.encode("utf-8")) for w in words], np.uint64)
    top, third = levels[0][0], levels[1][0]
    first, second = top >> 32, top & _LOWER
    h2 = _mix(_mix(np.uint64(0), h[first]), h[second])
    h3 = _mix(h2[third >> 32], h[third & _LOWER])
    where = [(h2 % np.uint64(buckets)).astype(np.int64), (h3 % np.uint64(buckets)).astype(np.int64)]
    for runs, _, _ in levels[2:]:
        where.append(where[-1][runs >> 32])
    orders = [np.argsort(b, kind="stable") for b in where]
    edges = [np.searchsorted(b[o], np.arange(buckets + 1)) for b, o in zip(where, orders, strict=True)]
    places = []
    for o in orders:
        places.append(np.empty(len(o), np.int64))
        places[-1][o] = np.arange(len(o))
    for b in range(buckets):
        of = [o[e[b] : e[b + 1]] for o, e in zip(orders, edges, strict=True)]
        if not any(len(o) for o in of):
            continue
        begun = third[of[1]] >> 32
        used = [first[of[0]], second[of[0]], first[begun], second[begun], *[lv[0][o] & _LOWER for lv, o in zip(levels[1:], of[1:], strict=True)]]
        every = np.concatenate(used)
        flags = np.zeros(len(words), bool)
        flags[every] = True
        known, short = np.flatnonzero(flags), (np.cumsum(flags) - 1)[every]
        arrays = np.split(short, np.cumsum([len(u) for u in used])[:-1])
        for i in (0, 2):  # first words are in order
            arrays[i] = np.diff(arrays[i], prepend=0)
        for i in (2, 3):  # below a run of three or four words
            arrays.append(np.diff(places[i - 1][levels[i][0][of[i]] >> 32] - edges[i - 1][b], prepend=0))
        for (_, times, docs), o in zip(levels, of, strict=True):
            arrays += [times[o], docs[o]]
        yield b, _pack(arrays, [words[i] for i in known.tolist()])


def _spread(buckets: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, parts, sizes, docs, held, doc, last = _Names(), [], [], [], 0, -1, object()

        def out() -> Iterator[pa.RecordBatch]:
            if not parts:
                return
            n, order = np.array(sizes), sorted(names)
            place = np.empty(len(order), np.int64)
            place[np.fromiter(map(names.__getitem__, order), np.int64, len(order))] = np.arange(len(order))
            left = np.repeat(np.cumsum(n), n) - np.arange(n.sum())
            for b, blob in _dealt(place[np.concatenate(parts)], left, np.repeat(np.array(docs), n), order, buckets):
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([blob], pa.binary())], names=["bucket", "blob"])

        for batch in batches:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if doc < 0 or k != last:
                    doc, last = doc + 1, k
                    if held >= FLUSH_WORDS:
                        yield from out()
                        names, parts, sizes, docs, held = _Names(), [], [], [], 0
                        _tidy()
                found = _words(t) if t else []
                if len(found) >= LOW:
                    parts.append(np.fromiter(map(names.__getitem__, found), np.int64, len(found)))
                    sizes.append(len(found))
                    docs.append(doc)
                    held += len(found)
        yield from out()
        names, parts = _Names(), []
        _tidy()

    return run


def _joined(blobs: list[bytes]) -> tuple[list[str], list[tuple[np.ndarray, ...]]]:
    """Words, and for 2 to 5 of them the runs of a bucket: (run without its last word, last word, times, documents,
    characters), where a run without its last word is one of the level before; of 2 words its first word, of 3 a pair."""
    names, parts, bases = _Names(), [], [0, 0]
    for blob in blobs:
        a, words = _unpack(blob)
        own = np.fromiter(map(names.__getitem__, words), np.int64, len(words))
        for i in range(7):
            a[i] = own[np.cumsum(a[i]) if i in (0, 2) else a[i]]
        for i in (0, 1):
            a[7 + i] = np.cumsum(a[7 + i]) + bases[i]
            bases[i] += len(a[4 + i])
        parts.append(a)
    a = [np.concatenate(x) for x in zip(*parts, strict=True)]
    words = list(names)
    size = np.array([len(w) for w in words])
    pairs, pair, _, _ = _ranked(a[2] << 32 | a[3])
    above, out, lengths = [a[0], pair, None, None], [], [size, size[pairs >> 32] + 1 + size[pairs & _LOWER], None, None]
    for i, (last, times, docs) in enumerate(((a[1], a[9], a[10]), (a[4], a[11], a[12]), (a[5], a[13], a[14]), (a[6], a[15], a[16]))):
        if i > 1:
            above[i], lengths[i] = ranks[a[5 + i]], out[-1][4]
        runs, ranks, order, starts = _ranked(above[i] << 32 | last)
        both = [np.add.reduceat(x[order], starts) if len(starts) else x for x in (times, docs)]
        out.append((runs >> 32, runs & _LOWER, *both, lengths[i][runs >> 32] + 1 + size[runs & _LOWER]))
    return words, [*out, (pairs >> 32, pairs & _LOWER)]


def _texts(words: list[str], levels: list, i: int, rows: np.ndarray) -> list[str]:
    """The runs of a level as texts."""
    last = [words[w] for w in levels[i][1][rows].tolist()]
    above = levels[i][0][rows]
    if i == 0:
        head = [words[w] for w in above.tolist()]
    elif i == 1:
        head = [f"{words[x]} {words[y]}" for x, y in zip(levels[4][0][above].tolist(), levels[4][1][above].tolist(), strict=True)]
    else:
        head = _texts(words, levels, i - 1, above)
    return [f"{h} {w}" for h, w in zip(head, last, strict=True)]


def _buckets(documents: DataFrame, text: Column, key: str) -> DataFrame:
    """Packed runs by bucket. Rows of one key are one document; only those of keys that several rows have are dealt out."""
    rows = documents.select(F.col(key).alias("k"), text.cast("string").alias("t"))
    several = rows.groupBy("k").agg(F.count("*").alias("n")).where("n > 1").select(F.col("k").alias("key"))
    same = F.col("k").eqNullSafe(F.col("key"))
    if several.isEmpty():
        parts = [rows]
    else:
        parts = [rows.join(several, same, "left_anti"), rows.join(several, same, "left_semi").repartition("k").sortWithinPartitions("k")]
    chars = rows.agg(F.sum(F.char_length("t"))).first()[0] or 0
    buckets = max(1, -(-chars // BUCKET_CHARS))
    packed = [p.mapInArrow(_spread(buckets), "bucket int, blob binary") for p in parts]
    return packed[0] if len(packed) == 1 else packed[0].union(packed[1])


def _by_bucket(documents: DataFrame, text: Column, key: str, run: Callable[[list[str], list], pa.RecordBatch], schema: str) -> DataFrame:
    """What ``run`` makes of the words and runs of each bucket."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, blobs = None, []
        for batch in batches:
            for b, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if b != bucket:
                    if blobs:
                        yield run(*_joined(blobs))
                        _tidy()
                    bucket, blobs = b, []
                blobs.append(blob)
        if blobs:
            yield run(*_joined(blobs))
            blobs = []
            _tidy()

    return _buckets(documents, text, key).repartition("bucket").sortWithinPartitions("bucket").mapInArrow(each, schema)


def phrase_counts(documents: DataFrame, text: Column, key: str, least: int = 0, least_documents: int = 0, top: int | None = None, shortest: int = 10, longest: int = 100) -> DataFrame:
    """``phrase``, ``occurrences`` and ``documents`` (distinct ``key``s) of the runs of words of ``shortest`` to ``longest``
    characters. Runs that are rarer than ``least`` or ``least_documents`` are counted and left out of the result, and so are, with
    ``top``, those that are not among so many most common ones (ties by phrase). The rows of one key are held at once."""

    def run(words: list[str], levels: list) -> pa.RecordBatch:
        picked = []
        for i, (_, _, times, docs, chars) in enumerate(levels[:4]):
            picked.append(np.flatnonzero((chars >= shortest) & (chars <= longest) & (times >= least) & (docs >= least_documents)))
        if top is not None and sum(map(len, picked)) > top:
            every = np.concatenate([levels[i][2][p] for i, p in enumerate(picked)])
            bound = np.partition(every, len(every) - top)[len(every) - top]
            picked = [p[levels[i][2][p] >= bound] for i, p in enumerate(picked)]
        found = [x for i, p in enumerate(picked) for x in zip(_texts(words, levels, i, p), levels[i][2][p].tolist(), levels[i][3][p].tolist(), strict=True)]
        if top is not None:
            found = sorted(found, key=lambda x: (-x[1], x[0]))[:top]
        kinds = ((0, pa.string()), (1, pa.int64()), (2, pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array([x[c] for x in found], kind) for c, kind in kinds], names=["phrase", "occurrences", "documents"])

    counts = _by_bucket(documents, text, key, run, "phrase string, occurrences long, documents long")
    return counts if top is None else counts.orderBy(F.desc("occurrences"), "phrase").limit(top)


def phrase_histogram(documents: DataFrame, text: Column, key: str, shortest: int = 10, longest: int = 100) -> DataFrame:
    """By how often runs of words occur (``occurrences``): how many do, and the sums of their documents and characters."""
    schema = ("occurrences", "phrases", "documents", "characters")

    def run(words: list[str], levels: list) -> pa.RecordBatch:
        fit = [(x[4] >= shortest) & (x[4] <= longest) for x in levels[:4]]
        times, docs, chars = (np.concatenate([x[c][f] for x, f in zip(levels[:4], fit, strict=True)]) for c in (2, 3, 4))
        values, _, order, starts = _ranked(times)
        sums = [np.add.reduceat(x[order], starts) if len(starts) else x for x in (np.ones(len(times), np.int64), docs, chars)]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (values, *sums)], names=schema)

    each = _by_bucket(documents, text, key, run, ", ".join(f"{c} long" for c in schema))
    return each.groupBy("occurrences").agg(*[F.sum(c).alias(c) for c in schema[1:]])
