"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by exact length, the words that are left after whole passes over a source are split over the
lengths, and what remains is met by a bounded-knapsack programme over the counts. Which documents of a length are
taken follows a seeded hash, so reruns agree.

The split gives every length its share of the budget in whole documents, so less than one document of each length
remains. Where that is still more than ``KNAPSACK_WORDS``, single documents are taken from the longest down until it is
not, as a programme over all of it would hold too much; the last words are met exactly wherever the documents left allow it.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.common import nested, word_count
from corpusloom.session import written

#: Rows of one source and length that a task ranks; there are as many buckets of them as all rows make.
SALT_ROWS = 50_000
#: Sources up to which their table (a row each) is broadcast; more are joined.
BROADCAST_SOURCES = 100_000
#: Words below which the rest of a budget goes to the knapsack programme.
KNAPSACK_WORDS = 50_000


def targets(sizes: Sequence[tuple[str | None, int]], weights: Sequence[float], share: float, most: float) -> dict[str | None, float]:
    """Words to take from each source.

    Sources by code point, null last, get ``weights`` in turn and split ``share`` times all words by weight; a target
    stops at ``most`` times its source's words, and the excess is shared again among the others until none is above.
    """
    ordered = sorted((s for s, _ in sizes if s is not None), key=lambda s: s.encode("utf-8")) + [s for s, _ in sizes if s is None]
    size, weight = dict(sizes), {s: weights[i % len(weights)] for i, s in enumerate(ordered)}
    out: dict[str | None, float] = {}
    left, free = share * sum(size.values()), list(ordered)
    while free:
        per = left / sum(weight[s] for s in free)
        full = [s for s in free if per * weight[s] >= most * size[s]]
        if not full:
            return out | {s: per * weight[s] for s in free}
        for s in full:
            out[s] = float(most * size[s])
            left -= out[s]
        free = [s for s in free if s not in out]
    return out


def knapsack(goal: int, lengths: Sequence[int], counts: Sequence[int]) -> list[int]:
    """How many documents of each length make the largest total that is at most ``goal`` (bounded subset sum).

    Reachable totals are the bits of one integer; counts are split into powers of two, so each length adds a
    logarithmic number of shifts. The programme ends as soon as the goal itself is reachable.
    """
    taken, mask = [0] * len(lengths), (1 << (goal + 1)) - 1
    reach, steps = 1, []
    for i, (length, count) in enumerate(zip(lengths, counts, strict=True)):
        count = min(count, goal // length) if length else 0
        part = 1
        while count > 0:
            part = min(part, count)
            steps.append((i, part, part * length, reach))
            reach |= (reach << (part * length)) & mask
            count, part = count - part, part * 2
        if reach >> goal & 1:
            break
    total = reach.bit_length() - 1
    for i, part, words, before in reversed(steps):
        if not before >> total & 1:
            taken[i] += part
            total -= words
    return taken


def fit(budget: int, lengths: Sequence[int], counts: Sequence[int], knapsack_words: int = KNAPSACK_WORDS) -> list[int]:
    """Documents to take of each length so that their words come as near to ``budget`` as they can from below."""
    total = sum(n * c for n, c in zip(lengths, counts, strict=True))
    if budget <= 0 or total <= 0:
        return [0] * len(lengths)
    taken = [c if budget >= total else c * budget // total for c in counts]
    rest = budget - sum(n * t for n, t in zip(lengths, taken, strict=True))
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        if rest <= knapsack_words:
            break
        if lengths[i] and taken[i] < counts[i] and rest - lengths[i] >= 0:
            more = min(counts[i] - taken[i], 1 + (rest - knapsack_words) // lengths[i] // max(1, len(lengths)), rest // lengths[i])
            taken[i] += more
            rest -= more * lengths[i]
    more = knapsack(max(0, rest), lengths, [c - t for c, t in zip(counts, taken, strict=True)])
    return [t + m for t, m in zip(taken, more, strict=True)]


def mix_sources(
    documents: DataFrame,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: int = 2,
    seed: int = 20,
) -> DataFrame:
    """Each input row, as struct ``row``, with ``size``, ``source_size``, ``target`` and ``taken`` words.

    ``taken`` is a multiple of ``size`` from 0 to ``most`` times it. Null texts and texts without words have size 0
    and are never taken; a null source is a source of its own, last in order; repeated rows are separate documents
    that share a source and length, so any of them may be the one taken. An empty table gives an empty result.
    Further columns of any name are allowed. The table of sources (one row each, as weights are stated by source) is
    held by the driver; the lengths of a source are fitted in one task, which sees a row for each distinct length and
    never the documents.
    """
    base = nested(documents)
    salts = max(1, -(-documents.count() // SALT_ROWS))
    row = F.col("row")
    base = base.select(
        "row",
        word_count(row[text]).alias("size"),
        row[source].alias("source"),
        F.xxhash64(F.lit(seed), row[key], row[text]).alias("draw"),
    ).withColumn("salt", F.pmod(F.col("draw"), F.lit(salts)).cast("int"))
    hist = written(base.groupBy("source", "size", "salt").agg(F.count("*").alias("n")), "lengths")
    sizes = [(r["source"], int(r["words"])) for r in hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("words")).collect()]
    goal = targets(sizes, weights, share, most)
    spark = documents.sparkSession
    plan = spark.createDataFrame(
        [(s, n, float(goal[s]), int(round(goal[s])) // n if n else 0, int(round(goal[s])) % n if n else 0) for s, n in sizes],
        "source string, source_size long, target double, whole int, budget long",
    )

    held = F.broadcast(plan) if len(sizes) <= BROADCAST_SOURCES else plan

    def fitted(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("size").reset_index(drop=True)
        budget = int(frame["budget"].iloc[0])
        frame["extra"] = fit(budget, [int(x) for x in frame["size"]], [int(x) for x in frame["n"]])
        return frame[["source", "size", "extra"]]

    by_length = hist.groupBy("source", "size").agg(F.sum("n").alias("n"))
    extra = (
        by_length.join(held, by_length["source"].eqNullSafe(plan["source"]))
        .select(by_length["source"], "size", "n", "budget")
        .groupBy("source")
        .applyInPandas(fitted, "source string, size long, extra long")
    )
    h, e = hist.alias("h"), extra.alias("e")
    before = F.sum("n").over(Window.partitionBy("source", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    quota = (
        h.join(e, F.col("h.source").eqNullSafe(F.col("e.source")) & (F.col("h.size") == F.col("e.size")))
        .select("h.source", "h.size", "salt", "n", "extra")
        .select("source", "size", "salt", F.greatest(F.lit(0), F.least("n", F.col("extra") - F.coalesce(before, F.lit(0)))).alias("quota"))
    )
    rank = F.row_number().over(Window.partitionBy("source", "size", "salt").orderBy("draw"))
    b, q = base.withColumn("rank", rank).alias("b"), quota.alias("q")
    same = F.col("b.source").eqNullSafe(F.col("q.source")) & (F.col("b.size") == F.col("q.size")) & (F.col("b.salt") == F.col("q.salt"))
    p = held.alias("p")
    mixed = b.join(q, same).join(p, F.col("b.source").eqNullSafe(F.col("p.source")))
    times = F.col("whole") + (F.col("rank") <= F.col("quota")).cast("int")
    return mixed.select("row", "b.size", "source_size", "target", (F.col("b.size") * times).alias("taken"), F.when(F.col("b.size") > 0, times).otherwise(0).alias("times"))


def repeated(mixed: DataFrame) -> DataFrame:
    """The mixed corpus itself: every document as often as the mix takes it."""
    many = mixed.where("times > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"))
    return many.select("row.*")
