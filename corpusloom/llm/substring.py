"""Substring dedup over words by level-wise doubling.

Windows are first compared at a short length; those that repeat at one length alone are extended to twice that length,
up to the full window, and what does not repeat at a level is never looked at again. The first level and the levels of
large groups are counted over the whole table (``repeats``), the others within a group, where a run's name is the pair
of the names of its halves: names are exact, from the words themselves on.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from corpusloom.llm.common import Batches, steady
from corpusloom.llm.repeats import Segment, by_row, covered, distinct_texts, find_repeats, levels
from corpusloom.session import Scratch

#: Words of the first level.
FIRST = 8


def doubling(window: int):
    """A matcher: runs of 1, 2, 4, ... and last ``window`` words, each made of two runs that repeat."""

    def match(rows: list[Segment]) -> list[np.ndarray]:
        numbers: dict[bytes, int] = {}
        name = np.array([numbers.setdefault(w, len(numbers)) for r in rows for w in r[3].split(b" ")], dtype=np.int64)
        n = np.array([r[4] for r in rows], dtype=np.int64)
        units = n + window - 1
        stop = np.repeat(np.cumsum(units), units)  # where the segment of each word ends
        weight = np.repeat(np.array([r[2] for r in rows], dtype=np.float64), units)
        alive, length = np.arange(len(name)), 1
        while len(alive) and length < window:
            step = min(length, window - length)
            living = np.zeros(len(name) + step, dtype=bool)
            living[alive] = True
            # a run is made of two runs that live; the second begins ``step`` words on and ends with the segment at most
            alive = alive[(alive + length + step <= stop[alive]) & living[alive + step]]
            _, group = np.unique(name[alive] * len(name) + name[alive + step], return_inverse=True)
            repeats = np.bincount(group, weights=weight[alive])[group] > 1 if len(group) else np.zeros(0, dtype=bool)
            alive, group = alive[repeats], group[repeats]
            name = np.full(len(name), -1)
            name[alive] = group
            length += step
        if length < window or window == 1:  # a window of one word is its word
            seen = np.bincount(name, weights=weight) if window == 1 else np.zeros(0)
            alive = np.flatnonzero(seen[name] > 1) if window == 1 else alive[:0]
        out = np.zeros(int(units.sum()), dtype=bool)
        out[alive] = True
        begins = np.cumsum(units) - units
        return [out[b : b + k] for b, k in zip(begins.tolist(), n.tolist(), strict=True)]

    return match


def remove_repeats(documents: DataFrame, text: str = "text", key: str = "doc_id", window: int = 35, with_text: bool = True) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept`` (words joined by one space, if ``with_text``) and ``kept_sha256``
    of every row.

    A word goes if a window of ``window`` words that covers it has the same words as a window that starts anywhere
    else, the same document included; repeated rows are different documents. Null, empty and blank texts have no words
    and stay empty; texts shorter than a window lose nothing; very long texts go in blocks of windows. Null and
    repeated keys are allowed, and so are further columns of any name. An empty table gives an empty result.
    """
    scratch = Scratch(documents.sparkSession)
    texts = distinct_texts(documents, text, scratch)
    found = find_repeats(texts, "words", window, levels(FIRST, window), doubling(window), scratch)
    joined = texts.join(found.hint("shuffle_hash"), "tid", "left").select("tid", "copies", "text", "found")

    @steady
    def finish(batches: Batches) -> Batches:
        for b in batches:
            split = [t.encode("utf-8", "replace").split() for t in b.column(2).to_pylist()]
            n_words = np.array([len(w) for w in split], dtype=np.int64)
            gone, begins = covered(b.column(3), n_words, b.column(1).to_numpy(), window)
            n_removed, kept = [], []
            for w, a in zip(split, begins.tolist(), strict=True):
                own = gone[a : a + len(w)]
                n_removed.append(int(np.count_nonzero(own)))
                kept.append(b" ".join(itertools.compress(w, ~own) if n_removed[-1] else w))
            sha = [hashlib.sha256(k).hexdigest() for k in kept]
            arrays = [b.column(0), pa.array(n_words), pa.array(n_removed, pa.int64()), pa.array(sha)]
            names = ["tid", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                arrays, names = [*arrays, pa.array([k.decode() for k in kept])], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    results = scratch.table(joined.mapInArrow(finish, "tid binary, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text), "results")
    scratch.drop(texts, found)
    return by_row(documents, text, key, results)
