"""Language identification by prediction by partial matching.

For each language a variable-order context tree over bytes gives every next byte a probability: the longest context
seen in training predicts with its counts, and leaves an escape probability (the share of distinct followers) for the
next shorter context, with the bytes it has already predicted excluded. The statistics are frozen after training, so
the code length of each (context, byte) that some language has seen is a number computed once, and any other is the
cost of the escape and the code length after the shorter context. All 256 bytes are kept apart. A text's score under
a language is the exact sum over all its bytes, and the shortest code wins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import Batches, small_batches, steady
#: Languages that are learned, the most frequent ones; the number of bytes there are; the longest context.
LANGUAGES, SYMBOLS, ORDER = 500, 256, 3
#: Of no use since every labelled document is learned from.
ALL_DOCS = 100_000
#: Numbers that a task counts at once.
COUNT_GRAMS = 1 << 20
#: One labelled document in so many is spared from training where rejection bounds are asked for (see ``bounds``).
SPARE = 8
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")


#: Of a hash table for numbers: the numbers by slot, their rows by slot (-1: none), and the shift that gives a slot.
Table = tuple[np.ndarray, np.ndarray, int]
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Model:
    """Frozen statistics by length of the context, from none to ``order`` bytes: where the (context, byte) numbers that
    some language has seen have their bits by language, and where the contexts have the bits of an escape by language
    (0 where a language has not seen the context). The last row of each array is 0."""

    languages: tuple[str, ...]
    seen: tuple[tuple[Table, np.ndarray], ...]
    escapes: tuple[tuple[Table, np.ndarray], ...]
    order: int

    @property
    def symbols(self) -> int:
        return SYMBOLS


def _table(keys: np.ndarray) -> Table:
    """A hash table of distinct numbers, which gives their places in ``keys``."""
    width = max(4, int(2 * len(keys)).bit_length())
    slots, rows, shift = np.zeros(1 << width, np.uint64), np.full(1 << width, -1, np.int32), 64 - width
    left = np.arange(len(keys))
    at = ((keys * _ODD) >> np.uint64(shift)).astype(np.int64)
    while len(left):
        free = np.flatnonzero(rows[at] < 0)
        spot, first = np.unique(at[free], return_index=True)
        won = free[first]
        slots[spot], rows[spot] = keys[left[won]], left[won]
        rest = np.ones(len(left), dtype=bool)
        rest[won] = False
        left, at = left[rest], (at[rest] + 1) & ((1 << width) - 1)
    return slots, rows, shift


def _find(table: Table, keys: np.ndarray) -> np.ndarray:
    """The row of each number, -1 where the table lacks it."""
    slots, rows, shift = table
    at = ((keys * _ODD) >> np.uint64(shift)).astype(np.int64)
    out = rows[at]
    other = np.flatnonzero((out >= 0) & (slots[at] != keys))
    while len(other):
        at[other] = (at[other] + 1) & (len(rows) - 1)
        out[other] = rows[at[other]]
        other = other[(out[other] >= 0) & (slots[at[other]] != keys[other])]
    return out


def _low(keys: np.ndarray, n: int) -> np.ndarray:
    """The last ``n`` bytes."""
    return keys & np.uint64((1 << 8 * n) - 1)


def _grams(data: bytes, order: int) -> np.ndarray:
    """For each byte the number that its context and itself make; a text starts after ``order`` spaces."""
    s = np.frombuffer(b" " * order + data, dtype=np.uint8)
    n = len(s) - order
    g = s[:n].astype(np.uint64)
    for k in range(1, order + 1):
        g = (g << np.uint64(8)) | s[k : k + n]
    return g


def sparse_code_lengths(grams: np.ndarray, counts: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By length of the context, what ``code_lengths`` says: the (context, byte) numbers seen and their bits; the contexts
    and the bits that an escape from them adds to the code length after the shorter context."""
    levels = []
    for k in range(order, -1, -1):
        keys, at = np.unique(_low(grams, k + 1), return_inverse=True)
        levels.append((keys, np.bincount(at, weights=counts)))
    out, shorter, lower = [], None, None
    for k, (keys, c) in enumerate(reversed(levels)):
        contexts, own = np.unique(keys >> np.uint64(8), return_inverse=True)
        n, q = np.bincount(own, weights=c), np.bincount(own)
        below = np.full(len(keys), 1.0 / SYMBOLS) if shorter is None else lower[np.searchsorted(shorter, _low(keys, k))]
        rest = np.maximum(1.0 - np.bincount(own, weights=below), 1e-12)
        escape = np.where(q < SYMBOLS, q / (n + q), 0.0)
        p = c / n[own] * (1.0 - escape[own])
        out.append((keys, -np.log2(p), contexts, -np.log2(np.maximum(escape / rest, 1e-12))))
        shorter, lower = keys, p
    return out


def model_of(counts: dict[str, tuple[np.ndarray, np.ndarray]], order: int) -> Model:
    """The model of the languages whose (context, byte) numbers and counts are given."""
    languages = tuple(sorted(counts))
    each = [sparse_code_lengths(*counts[lang], order) for lang in languages]
    seen, escapes, shorter, lower = [], [], None, None
    for k in range(order + 1):
        keys = np.unique(np.concatenate([e[k][0] for e in each]))
        contexts = np.unique(keys >> np.uint64(8))
        add = np.zeros((len(contexts) + 1, len(languages)))
        for i, e in enumerate(each):
            add[np.searchsorted(contexts, e[k][2]), i] = e[k][3]
        below = np.full((len(keys), len(languages)), np.log2(SYMBOLS)) if shorter is None else lower[np.searchsorted(shorter, _low(keys, k))]
        bits = np.vstack([below + add[np.searchsorted(contexts, keys >> np.uint64(8))], np.zeros((1, len(languages)))])
        for i, e in enumerate(each):
            bits[np.searchsorted(keys, e[k][0]), i] = e[k][1]
        seen.append((_table(keys), bits.astype(np.float32)))
        escapes.append((_table(contexts), add.astype(np.float32)))
        shorter, lower = keys, bits
    return Model(languages, tuple(seen), tuple(escapes), order)


def code_lengths(counts: np.ndarray, symbols: int, order: int) -> np.ndarray:
    """Bits of each symbol after each context of ``order`` symbols, from counts of such (context, symbol) numbers."""
    levels = [counts.astype(np.float64).reshape(-1, symbols)]
    for _ in range(order):  # the shorter context is the later part
        c = levels[-1].reshape(symbols, -1, symbols)
        levels.append(c.sum(axis=0))
    p = np.full((1, symbols), 1.0 / symbols)
    for c in reversed(levels):
        lower = np.tile(p, (c.shape[0] // p.shape[0], 1))
        seen = c > 0
        n, q = c.sum(axis=1, keepdims=True), seen.sum(axis=1, keepdims=True)
        rest = np.where(seen, 0.0, lower).sum(axis=1, keepdims=True)
        escape = np.where(rest > 0, q / np.maximum(n + q, 1.0), 0.0)
        own = np.where(n > 0, c / np.maximum(n, 1.0), 0.0) * (1.0 - escape)
        fill = np.where(seen, 0.0, lower) / np.maximum(rest, 1e-300) * escape
        p = np.where(n > 0, own + fill, lower)
    return (-np.log2(np.maximum(p, 1e-12))).astype(np.float32).reshape(-1)


def train(labelled: DataFrame, order: int = ORDER) -> Model:
    """Fit a model to all rows of (``lang``, ``text``): a null language or text teaches nothing.

    The ``LANGUAGES`` most frequent labels are learned (ties by code point). The driver gets the distinct (context, byte)
    numbers with their counts by language, so its memory grows with how many different runs of ``order`` + 1 bytes a
    language has, not with the number of documents.
    """
    spark = labelled.sparkSession
    small_batches(spark)
    rows = labelled.where("lang is not null and text is not null")
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    languages = tuple(sorted(r["lang"] for r in counts.collect()))
    if not languages:
        return Model((), (), (), order)
    place = {lang: i for i, lang in enumerate(languages)}

    @steady
    def gram_counts(batches: Batches) -> Batches:
        totals: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        waiting: dict[int, list[np.ndarray]] = {}
        size = 0

        def count() -> None:
            for at, g in waiting.items():
                keys, n = np.unique(np.concatenate(g), return_counts=True)
                if at in totals:
                    old, m = totals[at]
                    keys, own = np.unique(np.concatenate([old, keys]), return_inverse=True)
                    n = np.bincount(own, weights=np.concatenate([m, n])).astype(np.int64)
                totals[at] = keys, n
            waiting.clear()

        for b in batches:
            for lang, t in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
                if (at := place.get(lang)) is None:
                    continue
                waiting.setdefault(at, []).append(_grams(t.encode("utf-8", "replace"), order))
                size += len(waiting[at][-1])
                if size >= COUNT_GRAMS:
                    count()
                    size = 0
        count()
        for at, (keys, n) in totals.items():
            for a in range(0, len(keys), 1 << 16):
                k, m = keys[a : a + (1 << 16)], n[a : a + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), at, np.int32)), pa.array(k.view(np.int64)), pa.array(m, pa.int64())], names=["lang", "gram", "n"])

    found = rows.select("lang", "text").mapInArrow(gram_counts, "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    langs, keys, n = found.column("lang").to_numpy(), found.column("gram").to_numpy().view(np.uint64), found.column("n").to_numpy()
    nothing = _grams(b"", order), np.zeros(0, np.int64)
    counts = {lang: (keys[own], n[own]) if (own := langs == place[lang]).any() else nothing for lang in languages}
    return model_of(counts, order)


def _bits(model: Model, parts: list[np.ndarray]) -> np.ndarray:
    """Bits by language of each part, none of them empty."""
    sizes = np.array([len(p) for p in parts])
    left = np.concatenate(parts)
    part = None
    for k in range(model.order, -1, -1):
        table, bits = model.seen[k]
        rows = _find(table, _low(left, k + 1))
        if part is None:
            out = np.add.reduceat(bits.take(rows, axis=0, mode="wrap"), np.cumsum(sizes) - sizes, axis=0, dtype=np.float64)
            part = np.repeat(np.arange(len(parts)), sizes)
        else:
            out += _sums(bits.take(rows, axis=0, mode="wrap"), part, len(parts))
        missed = np.flatnonzero(rows < 0)
        left, part = left[missed], part[missed]
        if not len(left):
            return out
        table, add = model.escapes[k]
        out += _sums(add.take(_find(table, _low(left, k + 1) >> np.uint64(8)), axis=0, mode="wrap"), part, len(parts))
    return out + np.log2(SYMBOLS) * np.bincount(part, minlength=len(parts))[:, None]


def _sums(x: np.ndarray, part: np.ndarray, parts: int) -> np.ndarray:
    return np.stack([np.bincount(part, weights=c, minlength=parts) for c in x.T], axis=1)


def score(model: Model, texts: Sequence[str | None], block: int = 1 << 20) -> tuple[list[str], np.ndarray, np.ndarray]:
    """For each text its language, a score from 0 to 1, and the bits of each byte under the chosen language.

    The score is the normalised likelihood of the winner with code lengths tempered to a text of 40 bytes at most.
    ``und`` with score 0: the text is null or has no letter, or nothing was learned.
    """
    known = [t is not None and bool(_LETTER.search(t)) and bool(model.languages) for t in texts]
    total = np.zeros((len(texts), len(model.languages)))
    lengths = np.zeros(len(texts), dtype=np.int64)
    owners, parts, size = [], [], 0
    for i, (t, ok) in enumerate(zip(texts, known, strict=True)):
        if not ok:
            continue
        data = t.encode("utf-8", "replace")
        lengths[i] = len(data)
        for a in range(0, len(data), block):
            head = data[max(0, a - model.order) : a]
            owners.append(i)
            parts.append(_grams(head + data[a : a + block], model.order)[len(head) :])
            size += len(parts[-1])
            if size >= block:
                np.add.at(total, owners, _bits(model, parts))
                owners, parts, size = [], [], 0
    if parts:
        np.add.at(total, owners, _bits(model, parts))
    out, scores, rate = [], np.zeros(len(texts)), np.zeros(len(texts))
    for i, ok in enumerate(known):
        if not ok:
            out.append(UNDETERMINED)
            continue
        best = int(np.argmin(total[i]))
        gap = np.exp2(-np.minimum(60.0, (total[i] - total[i][best]) * (min(40, lengths[i]) / lengths[i])))
        out.append(model.languages[best])
        scores[i] = 1.0 / gap.sum()
        rate[i] = total[i][best] / lengths[i]
    return out, scores, rate


def _shared(spark: SparkSession, model: Model):
    """The model as a broadcast, one however often it is used: workers hold it as long as the driver does."""
    if not hasattr(model, "_shared"):
        object.__setattr__(model, "_shared", spark.sparkContext.broadcast((model.languages, model.seen, model.escapes, model.order)))
    return model._shared


def predict(documents: DataFrame, model: Model, text: Column | str, *keep: Column | str) -> DataFrame:
    """The columns ``keep`` of each row with ``lang_pred``, ``score`` and ``bits`` (per byte) of its whole text.

    ``text`` is a column, or the name of one of ``keep``, which then goes to the workers once. Null texts and those
    without a letter are ``und`` with score and bits 0; a very long text is coded in blocks, each after the bytes before.
    """
    spark = documents.sparkSession
    small_batches(spark)
    shared = _shared(spark, model)
    own = isinstance(text, str)
    thin = documents.select(*keep) if own else documents.select(*keep, text.cast("string").alias("__text"))
    kept = thin.columns if own else thin.columns[:-1]
    at = kept.index(text) if own else len(kept)
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in thin.schema.fields[: len(kept)])

    @steady
    def run(batches: Batches) -> Batches:
        m = Model(*shared.value)
        for b in batches:
            langs, scores, bits = score(m, b.column(at).to_pylist())
            arrays = [*b.columns[: len(kept)], pa.array(langs, pa.string()), pa.array(scores), pa.array(bits)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "lang_pred", "score", "bits"])

    return thin.mapInArrow(run, f"{schema}lang_pred string, score double, bits double")


def held_out(key: Column) -> Column:
    """Whether a document is kept from training: crc32 of its key as text, modulo 3, is 1 (a null key: no)."""
    return F.coalesce(F.crc32(F.encode(key.cast("string"), "utf-8")) % 3 == 1, F.lit(False))


def _labelled(documents: DataFrame) -> DataFrame:
    """Rows that may be learned from, with a uniform ``draw`` from the text."""
    return documents.where(~held_out(F.col("doc_id"))).select("lang", "text", F.xxhash64(F.lit(3), "text").alias("draw"))


def fit_on(documents: DataFrame, spare: int | None = None) -> Model:
    """A model of the documents that are not held out and have a language; one in ``spare`` is left for ``bounds``."""
    rows = _labelled(documents)
    return train(rows if spare is None else rows.where(F.pmod("draw", F.lit(spare)) != 0))


def bounds(documents: DataFrame, model: Model, spare: int = SPARE) -> dict[str, float]:
    """By language, the bits per byte above which a text is in none of the learned languages.

    From the code lengths of all labelled texts that were spared from training: the median, and six times as far above it as the 99th percentile is. A language with fewer than ten such
    texts gets the widest bound of the others, or bytes' own eight bits where there is none.
    """
    rows = _labelled(documents).where((F.pmod("draw", F.lit(spare)) == 0) & F.col("lang").isin(*model.languages))
    coded = predict(rows, model, "text", "lang", "text").where("lang = lang_pred")
    q = coded.groupBy("lang").agg(F.count("*").alias("n"), F.percentile_approx("bits", [0.5, 0.99], 1000).alias("q")).where("n >= 10").collect()
    found = {r["lang"]: min(8.0, r["q"][0] + 6 * (r["q"][1] - r["q"][0])) for r in q}
    widest = max(found.values(), default=8.0)
    return {lang: found.get(lang, widest) for lang in model.languages}


#: Bits that a whole text may cost beyond its language's bound, so that a few words are not judged by the rate alone.
SLACK = 40.0


def is_foreign(limits: dict[str, float], lang: Column, bits: Column, size: Column) -> Column:
    """Whether a text (of ``size`` bytes) is ``und`` or costs more than its language's bound."""
    bound = F.create_map(*[x for k, v in limits.items() for x in (F.lit(k), F.lit(v))])
    over = bits > F.try_element_at(bound, lang) + F.lit(SLACK) / F.greatest(size, F.lit(1))
    return (lang == UNDETERMINED) | F.coalesce(over, F.lit(False))


def identify(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` of every document; the text alone decides.

    Null texts and texts without a letter give ``und`` and score 0; so does everything if no row has a language.
    Repeated rows are each predicted, null ids are not held out, and further columns of any name are left out. An empty
    table gives an empty result.
    """
    model = fit_on(documents)
    return predict(documents, model, F.col("text"), F.col("doc_id"), held_out(F.col("doc_id")).alias("held_out")).drop("bits")
