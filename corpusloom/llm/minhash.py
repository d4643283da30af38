"""MinHash near-dedup: improved consistent weighted sampling over TF-IDF shingles, banded, verified.

A document is a weighted set of five-word shingles: the count of a shingle times the mean inverse document frequency
of its words. Consistent weighted sampling (Ioffe's improved form) draws from such sets so that two sets give the same
sample with a probability of their weighted Jaccard similarity. Samples are banded; documents that share a band are
candidates, and the exact weighted Jaccard similarity of their sets decides.

Exact copies are one text from the start. A bucket of a few texts gives the pairs whose samples agree enough. In any
other bucket every text is compared with one text of it, and the links merge their classes. If several classes are left,
what may still be linked meets in one task, which walks from class to class over exact similarities and gives only the
links that join two classes. A bucket too large for one task meets further centres while they take much of it away;
what is left is dealt to blocks, and any two blocks meet in such a task. So every pair of a bucket is settled exactly,
however large the bucket is, and none is cut.

Texts lie in buckets of their id, so a round deals out pairs of ids, and a text only to the tasks that compare it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import Batches, cached, small_batches, steady
from corpusloom.llm.repeats import Hasher, _mix, split_units, text_id
from corpusloom.session import Scratch, release

SHINGLE, THRESHOLD = 5, 0.8
#: At 0.8, a pair shares no band with probability (1 - 0.8 ** 3) ** 12 < 0.0002.
BANDS, ROWS = 12, 3
#: Words that fewer than one in ``RARE`` documents have weigh as if that many had them. At most ``RARE`` times the mean
#: number of distinct words of a document are more frequent; past ``MOST_WORDS`` the rarest of those join the others.
RARE, MOST_WORDS = 4096, 2_000_000
#: A bucket of up to ``FEW`` texts is settled by pairs; one of up to ``SMALL`` texts with up to ``TERMS`` shingles in
#: one task, after its centre has been met; a larger one in tasks of two blocks, together as large, once a centre has
#: left more than ``KEPT`` of it.
SMALL, TERMS, FEW, KEPT = 4096, 1_000_000, 16, 0.75
#: Of all samples, the share that a pair's must agree in to be verified: at a similarity of 0.8 and 36 samples,
#: fewer than half agree with a probability below 0.0001. A text and its bucket's centre are verified from a quarter on:
#: at a similarity of 0.6, below which the centre says nothing more, fewer agree with a probability below 0.0001.
AGREE, FAR = 0.5, 0.25
#: Members of a bucket that one task compares with its centre.
SALT_ROWS = 1000
_POOL, _LOW = 1 << 16, np.uint64((1 << 16) - 1)

#: Hashes of words in order, the inverse document frequency of each, and that of all other words.
Weights = tuple[np.ndarray, np.ndarray, float]


def _words(text: str | None) -> tuple[Hasher, np.ndarray, np.ndarray]:
    data, start, end = split_units(text, "words")
    return Hasher(data), start, end


def word_weights(docs: DataFrame) -> Weights:
    """Inverse document frequencies, log(1 + documents / document frequency), of the words that are not rare."""

    @steady
    def count(batches: Batches) -> Batches:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = n = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            words, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            return words, np.bincount(at, weights=np.concatenate([h[1] for h in held])).astype(np.int64)

        def batch(words: np.ndarray, counts: np.ndarray, n: int) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts), pa.array(np.concatenate([[n], np.zeros(len(words) - 1, np.int64)]))], names=["word", "df", "n"])

        for b in batches:
            own = []
            for t in b.column(0).to_pylist():
                h, s, e = _words(t)
                own.append(np.unique(h.of(s, e)))
            n += b.num_rows
            words, df = np.unique(np.concatenate([np.zeros(1, np.uint64), *own]), return_counts=True)
            held.append((words, df))
            size += len(words)
            if size > 1 << 20:
                held = [merged()]
                size = len(held[0][0])
                if size > 1 << 19:
                    yield batch(*held[0], n)
                    held, size, n = [], 0, 0
        if held:
            yield batch(*merged(), n)

    scratch = Scratch(docs.sparkSession)
    counted = scratch.table(docs.select("text").mapInArrow(count, "word long, df long, n long").groupBy("word").agg(F.sum("df").alias("df"), F.sum("n").alias("n")), "words")
    n = counted.agg(F.sum("n")).first()[0] or 0
    least = max(1, math.ceil(n / RARE))
    while counted.where(F.col("df") >= least).count() > MOST_WORDS:
        least *= 2
    found = counted.where((F.col("df") >= least) & (F.col("word") != 0)).select("word", "df").toArrow()
    scratch.drop(counted)
    words, df = found.column("word").to_numpy().view(np.uint64), found.column("df").to_numpy()
    order = np.argsort(words)
    return words[order], inverse_frequencies(n, df[order]), float(np.log1p(n / least))


def inverse_frequencies(n: int, df: np.ndarray) -> np.ndarray:
    """log(1 + documents / document frequency)."""
    return np.log1p(n / np.maximum(df, 1)).astype(np.float32)


def weighted_set(text: str | None, weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes in order and their weights; fewer than five words are one shingle."""
    h, s, e = _words(text)
    if not len(s):
        return np.zeros(0, np.uint64), np.zeros(0, np.float64)
    words, idf, other = weights
    hashes = h.of(s, e)
    if len(words):
        at = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
        own = np.where(words[at] == hashes, idf[at], other).astype(np.float64)
    else:
        own = np.full(len(s), other)
    k = min(SHINGLE, len(s))
    sums = np.concatenate([[0.0], np.cumsum(own)])
    mean = (sums[k:] - sums[:-k]) / k
    shingles, at, count = np.unique(h.of(s[: len(s) - k + 1], e[k - 1 :]), return_index=True, return_counts=True)
    return shingles, np.maximum(mean[at], 1e-6).round(9) * count


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity: the sum of the lesser over the sum of the greater weights; 1 for two empty sets."""
    if not len(a[0]) and not len(b[0]):
        return 1.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = float(np.minimum(a[1][i], b[1][j]).sum())
    return least / (float(a[1].sum()) + float(b[1].sum()) - least)


class Sampler:
    """Improved consistent weighted sampling with draws from pools. A shingle's hash picks each of its three draws by
    bits of its own, so that two shingles share all three once in 2**48 pairs."""

    def __init__(self, samples: int, seed: int = 5):
        self.pools = []
        for i in range(samples):
            rng = np.random.default_rng([seed, i])
            r = rng.gamma(2.0, 1.0, _POOL).astype(np.float32)
            self.pools.append((np.maximum(r, 1e-6), np.log(rng.gamma(2.0, 1.0, _POOL)).astype(np.float32), rng.random(_POOL, dtype=np.float32), np.uint64(rng.integers(1, 1 << 62) * 2 + 1)))

    def samples(self, sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """One row of samples for each non-empty set."""
        sizes = np.array([len(s[0]) for s in sets])
        starts = np.cumsum(sizes) - sizes
        hashes = np.concatenate([s[0] for s in sets])
        logs = np.log(np.concatenate([s[1] for s in sets])).astype(np.float32)
        out = np.empty((len(sets), len(self.pools)), dtype=np.uint64)
        for i, (r, c, beta, odd) in enumerate(self.pools):
            spot = hashes * odd
            rr, bb = r[(spot >> np.uint64(48)).astype(np.int64)], beta[((spot >> np.uint64(32)) & _LOW).astype(np.int64)]
            t = np.floor(logs / rr + bb)
            a = c[((spot >> np.uint64(16)) & _LOW).astype(np.int64)] - rr * (t - bb + 1)
            hit = np.flatnonzero(a == np.repeat(np.minimum.reduceat(a, starts), sizes))
            first = hit[np.searchsorted(hit, starts)]
            out[:, i] = _mix(hashes[first] ^ (t[first].astype(np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        return out


def signatures(docs: DataFrame, idf, bands: int, rows: int) -> DataFrame:
    """``tid``, its band hashes, samples and number of shingles, for texts with words."""

    @steady(keeps=("sampler",))
    def sign(batches: Batches) -> Batches:
        sampler, weights = cached("sampler", bands * rows, lambda: Sampler(bands * rows)), idf.value
        for b in batches:
            tids, sets = [], []
            for tid, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                s = weighted_set(t, weights)
                if len(s[0]):
                    tids.append(tid)
                    sets.append(s)
            if not sets:
                continue
            x = sampler.samples(sets).reshape(len(sets), bands, rows)
            key = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(sets), bands)).copy()
            for j in range(rows):
                key = _mix(key * np.uint64(0xC2B2AE3D27D4EB4F) + x[:, :, j])
            flat = pa.array(key.view(np.int64).reshape(-1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * bands, pa.int32()), flat)
            short = pa.array((x.reshape(-1) & np.uint64(0x7FFF)).astype(np.int16))
            samples = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * bands * rows, pa.int32()), short)
            terms = pa.array([len(s[0]) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(tids, pa.binary()), lists, samples, terms], names=["tid", "bands", "samples", "terms"])

    return docs.select("tid", "text").mapInArrow(sign, "tid binary, bands array<bigint>, samples array<smallint>, terms bigint")


def agreement(a: Column, b: Column) -> Column:
    """In how many places two texts' samples agree."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)


def likely_pairs(few: DataFrame, least: int) -> DataFrame:
    """Pairs (``x``, ``y``) of each small bucket of ``few`` (``bucket``, ``tid``, ``label``, ``samples``) that are of two
    classes and agree in ``least`` samples."""

    @steady
    def meet(batches: Batches) -> Batches:
        bucket, group = None, []

        def found() -> list[tuple[bytes, bytes]]:
            if len(group) < 2:
                return []
            x = np.array([g[2] for g in group], dtype=np.int16)
            names = [g[1] for g in group]
            i, j = np.nonzero(np.triu((x[:, None, :] == x[None, :, :]).sum(axis=2) >= least, 1))
            return [(group[a][0], group[b][0]) for a, b in zip(i.tolist(), j.tolist(), strict=True) if names[a] != names[b]]

        for b in batches:
            out: list[tuple[bytes, bytes]] = []
            for key, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if key != bucket:
                    out += found()
                    bucket, group = key, []
                group.append(row)
            yield _pairs(out)
        yield _pairs(found())

    def _pairs(out: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) or [(), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in cols], names=["x", "y"])

    dealt = few.select("bucket", "tid", "label", "samples").repartition("bucket").sortWithinPartitions("bucket", "tid")
    return dealt.mapInArrow(meet, "x binary, y binary")


def verified(pairs: DataFrame, texts: DataFrame, idf, centres: DataFrame) -> DataFrame:
    """The pairs (``x``, ``y``) with their exact weighted Jaccard similarity; ``texts`` lie in buckets of ``tid``, and
    ``centres`` is a table of each ``y`` and its number of ``salts``, so that Spark can split the pairs of one centre."""
    members = pairs.join(centres, "y").select("y", F.pmod(F.xxhash64("x"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("kind"), F.col("x").alias("tid"))
    heads = centres.select("y", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("kind"), F.col("y").alias("tid"))
    rows = texts.join(members.unionByName(heads).hint("shuffle_hash"), "tid").select("y", "salt", "kind", "tid", "text")
    dealt = rows.repartition("y", "salt").sortWithinPartitions("y", "salt", "kind")

    @steady
    def compare(batches: Batches) -> Batches:
        weights, centre, own = idf.value, None, None
        for b in batches:
            xs, ys, js = [], [], []
            for y, _, kind, x, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                s = weighted_set(t, weights)
                if kind == 0:
                    centre, own = y, s
                elif centre == y:
                    xs.append(x)
                    ys.append(y)
                    js.append(similarity(own, s))
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.binary()), pa.array(ys, pa.binary()), pa.array(js, pa.float64())], names=["x", "y", "similarity"])

    return dealt.mapInArrow(compare, "x binary, y binary, similarity double")


def joining_links(tids: list[bytes], names: list[bytes], sets: list[tuple[np.ndarray, np.ndarray]], threshold: float) -> list[tuple[bytes, bytes, float]]:
    """Links (x, y, similarity) that join the classes ``names`` of some texts as all their links would.

    Walks from text to text within a class; each is compared, over the shingles it has, with the texts that no walk has
    reached yet, and those it is linked to bring their classes along.
    """
    sizes = np.array([len(s[0]) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, term = np.unique(np.concatenate([s[0] for s in sets]), return_inverse=True)
    begins, weight = np.cumsum(sizes) - sizes, np.concatenate([s[1] for s in sets])
    totals = np.array([float(s[1].sum()) for s in sets])
    members: dict[bytes, list[int]] = {}
    for i, name in enumerate(names):
        members.setdefault(name, []).append(i)
    open_ = np.ones(len(sets), dtype=bool)
    out: list[tuple[bytes, bytes, float]] = []
    indexed, queue, untouched = len(sets) + 1, [], iter(list(members))
    while open_.any():
        if not queue:
            queue = [i for i in members[next(untouched)] if open_[i]]
            open_[queue] = False
            continue
        left = int(open_.sum())
        if left <= indexed // 2 or indexed > len(sets):  # postings of the open texts alone
            rows = np.flatnonzero(open_[owner])
            rows = rows[np.argsort(term[rows], kind="stable")]
            holder, held = owner[rows], weight[rows]
            starts = np.searchsorted(term[rows], np.arange(int(term.max()) + 2))
            indexed = left
        i = queue.pop()
        own = slice(begins[i], begins[i] + sizes[i])
        first, count = starts[term[own]], starts[term[own] + 1] - starts[term[own]]
        spots = np.repeat(first - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
        least = np.bincount(holder[spots], weights=np.minimum(np.repeat(weight[own], count), held[spots]), minlength=len(sets))
        for j in np.flatnonzero(open_ & (least >= (threshold - 1e-9) * (totals + totals[i] - least))).tolist():
            if open_[j] and (like := similarity(sets[i], sets[j])) >= threshold:
                out.append((tids[j], tids[i], like))
                new = [m for m in members[names[j]] if open_[m]]
                open_[new] = False
                queue += new
    return out


def settled(rows: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """Links that join the classes of each ``bucket`` of ``rows`` (``bucket``, ``tid``, ``label``), a bucket in a task."""
    dealt = texts.join(rows.hint("shuffle_hash"), "tid").select("bucket", "tid", "label", "text").repartition("bucket").sortWithinPartitions("bucket", "tid")

    @steady
    def settle(batches: Batches) -> Batches:
        weights, bucket, group = idf.value, None, []

        def links() -> list[tuple[bytes, bytes, float]]:
            return joining_links(*map(list, zip(*group, strict=True)), threshold) if len(group) > 1 else []

        def batch(found: list[tuple[bytes, bytes, float]]) -> pa.RecordBatch:
            cols = list(zip(*found, strict=True)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.binary(), pa.float64()), strict=True)], names=["x", "y", "similarity"])

        for b in batches:
            for key, tid, label, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if key != bucket:
                    yield batch(links())
                    bucket, group = key, []
                group.append((tid, label, weighted_set(t, weights)))
        yield batch(links())

    return dealt.mapInArrow(settle, "x binary, y binary, similarity double")


def by_blocks(rows: DataFrame) -> DataFrame:
    """``rows`` (``bucket``, ``tid``, ``label``, ``blocks``) of large buckets as buckets of two blocks each, so that any
    two texts of a bucket meet in one of them at least."""
    own = F.pmod(F.xxhash64("tid"), F.col("blocks")).cast("int")
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("own <> other")
    return dealt.select(F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("bucket"), "tid", "label")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node`` and the least node of its connected component, for links (``x``, ``y``): least labels spread along
    the links and along the labels themselves, so a chain shortens by half each round."""
    edges = scratch.table(links.select("x", "y").union(links.select("y", "x")).distinct(), "edges")
    labels = scratch.table(edges.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("label")).select(F.col("x").alias("node"), "label"), "labels")
    while True:
        near = edges.join(labels, edges["y"] == labels["node"]).groupBy("x").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["node"] == near["x"]).select("node", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("far"))
        after = step.join(jump, step["label"] == jump["via"], "left").select("node", F.least("label", "far").alias("label"), "old")
        after = scratch.table(after, "labels")
        changed = after.where("label != old").limit(1).count()
        scratch.drop(labels)
        labels = after
        if not changed:
            scratch.drop(edges)
            return labels.drop("old")


def _unsettled(state: DataFrame, seen: DataFrame, labels: DataFrame, found: DataFrame, reach: float) -> DataFrame:
    """What is left of buckets whose centre has been met, with ``before``, the texts that they had.

    The centre has met everyone. 1 less the similarity is a metric, so a text farther than twice ``reach`` from the
    centre has no link to a text that the centre is linked to, and one at a distance d only to those at a distance
    of d - ``reach`` or more. Texts that the centre is linked to stay only where such a partner may be left.
    """
    large = seen.where("how = 'centre'").select("bucket", "y", F.col("n").alias("before"))
    large = large.join(labels.select(F.col("tid").alias("y"), F.col("label").alias("ylabel")), "y")
    rows = state.drop("before").join(large, "bucket").where(F.col("tid") != F.col("y")).join(labels.select("tid", "label"), "tid")
    far = found.groupBy(F.col("x").alias("tid"), "y").agg((1 - F.first("similarity")).alias("far"))
    rows = rows.join(far, ["tid", "y"], "left").withColumn("out", F.col("label") != F.col("ylabel"))
    near = F.min(F.when(F.col("out") & (F.col("far") <= 2 * reach), F.col("far")))
    edge = rows.groupBy("bucket").agg(near.alias("edge"))
    rows = rows.join(edge, "bucket").where(F.col("out") | (F.coalesce("far", F.lit(1.0)) > reach) | (F.col("far") >= F.col("edge") - reach))
    return rows.select("tid", "samples", "terms", "bucket", "before")


def near_duplicates(
    documents: DataFrame, text: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS
) -> tuple[DataFrame, DataFrame]:
    """Classes of near duplicates: (``tid``, ``label``) of every text that is linked, and the verified links.

    Exact copies share a ``tid``; a text without a row of its own is its own class. Texts without words (null, empty,
    blank) are linked to nothing but their copies. Ties and repeated rows change nothing; very long texts are read
    whole. A pair of similarity ``threshold`` or more is linked, directly or through others, unless no band finds it
    (see ``BANDS``). An empty table gives no class and no link.
    """
    spark = documents.sparkSession
    small_batches(spark)
    scratch = Scratch(spark)
    docs = documents.select(text_id(F.col(f"`{text}`")).alias("tid"), F.col(f"`{text}`").cast("string").alias("text"))
    idf = spark.sparkContext.broadcast(word_weights(docs))
    signed = signatures(docs, idf, bands, rows).groupBy("tid").agg(F.first("bands").alias("bands"), F.first("samples").alias("samples"), F.first("terms").alias("terms"))
    signed = scratch.bucketed(signed, "signed", "tid")
    thin = scratch.table(signed.select("tid", F.explode("bands").alias("bucket")), "bands")
    full = scratch.table(thin.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "full")
    placed = scratch.table(thin.join(full, "bucket"), "placed")
    scratch.drop(thin, full)
    # a text that others are copies of shares bands with more texts than its copies do, and makes the best centre
    labels = placed.groupBy("tid").agg(F.sum("n").alias("degree")).select("tid", F.col("tid").alias("label"), "degree")
    labels = scratch.bucketed(labels, "classes", "tid")
    state = placed.select("tid", "bucket").join(signed.select("tid", "samples", "terms"), "tid")
    state = scratch.bucketed(state.withColumn("before", F.lit(None).cast("long")), "buckets", "tid")
    scratch.drop(placed, signed)
    # copies are one row before texts are dealt out; by a merge join at any size, as the ids of linked texts grow with the corpus
    texts = docs.groupBy("tid").agg(F.first("text").alias("text")).join(labels.select("tid").hint("merge"), "tid")
    texts = scratch.bucketed(texts, "texts", "tid")
    release(spark)
    least, low = math.ceil(AGREE * bands * rows), math.ceil(FAR * bands * rows)
    links = None
    while True:
        placed = state.join(labels, "tid")
        centre = F.max(F.struct("degree", "tid", "label", "samples")).alias("c")
        seen = placed.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("terms").alias("terms"), F.min("label").alias("a"), F.max("label").alias("z"), F.max("before").alias("before"), centre)
        fits = (F.col("n") <= SMALL) & (F.col("terms") <= TERMS)
        met = F.col("before").isNotNull()
        how = F.when(F.col("n") <= FEW, "pairs").when(met & fits, "task").when(met & (F.col("n") > KEPT * F.col("before")), "blocks").otherwise("centre")
        blocks = F.greatest(F.lit(2), F.ceil(2 * F.col("n") / SMALL), F.ceil(2 * F.col("terms") / TERMS)).cast("int")
        seen = seen.where("a != z").select("bucket", "n", how.alias("how"), blocks.alias("blocks"), F.col("c.tid").alias("y"), F.col("c.label").alias("ylabel"), F.col("c.samples").alias("ysamples"))
        seen = scratch.table(seen, "open")
        if not seen.limit(1).count():
            break
        opened = scratch.table(placed.select("bucket", "tid", "label", "samples").join(seen.drop("n"), "bucket"), "opened")
        release(spark)
        star = opened.where((F.col("label") != F.col("ylabel")) & (F.col("how") == "centre") & (agreement(F.col("samples"), F.col("ysamples")) >= low))
        pairs = star.select(F.col("tid").alias("x"), "y").union(likely_pairs(opened.where("how = 'pairs'"), least))
        pairs = scratch.table(pairs.distinct(), "pairs")
        centres = scratch.table(pairs.groupBy("y").agg(F.ceil(F.count("*") / SALT_ROWS).cast("int").alias("salts")), "centres")
        whole = opened.where("how = 'task'").select("bucket", "tid", "label")
        in_tasks = settled(whole.unionByName(by_blocks(opened.where("how = 'blocks'"))), texts, idf, threshold)
        found = scratch.table(verified(pairs, texts, idf, centres).unionByName(in_tasks), "similarities")
        scratch.drop(opened, pairs, centres)
        new = found.where(F.col("similarity") >= threshold)
        links = new if links is None else links.union(new)
        if new.limit(1).count():
            named = new.join(labels.select(F.col("tid").alias("x"), F.col("label").alias("lx")), "x").join(labels.select(F.col("tid").alias("y"), F.col("label").alias("ly")), "y")
            merged = components(named.select(F.col("lx").alias("x"), F.col("ly").alias("y")), scratch)
            after = labels.join(merged, labels["label"] == merged["node"], "left").select("tid", F.coalesce(merged["label"], labels["label"]).alias("label"), "degree")
            after = scratch.bucketed(after, "classes", "tid")
            scratch.drop(labels, merged)
            labels = after
        after = scratch.bucketed(_unsettled(state, seen, labels, found, 1 - threshold), "buckets", "tid")
        scratch.drop(state, seen)
        state = after
    classes_ = scratch.table(labels.select("tid", "label"), "classes")
    scratch.drop(state, seen, labels, texts)
    idf.unpersist()
    if links is None:
        links = spark.createDataFrame([], "x binary, y binary, similarity double")
    return classes_, links


def _least_by_text(documents: DataFrame, text: str, key: str, labels: DataFrame) -> DataFrame:
    """By distinct text: ``tid``, its class as ``label``, and ``least``, the first of its rows' keys (null last)."""
    k = F.col(f"`{key}`")
    rows = documents.select(text_id(F.col(f"`{text}`")).alias("tid"), F.struct(k.isNull().alias("none"), k.alias("key")).alias("key"))
    own = rows.groupBy("tid").agg(F.min("key").alias("least")).join(labels, "tid", "left")
    return own.select("tid", F.coalesce("label", "tid").alias("label"), "least")


def classes(documents: DataFrame, text: str = "text", key: str = "doc_id", **how) -> DataFrame:
    """Each input row, as struct ``row``, with ``class_id``: the least key of its class (see ``near_duplicates``)."""
    labels, _ = near_duplicates(documents, text, **how)
    scratch = Scratch(documents.sparkSession)
    own = scratch.table(_least_by_text(documents, text, key, labels), "least")
    # only classes of several texts meet by their label, and copies are one row there
    first = scratch.table(own.groupBy("label").agg(F.min("least").alias("first"), F.count("*").alias("n")).where("n > 1").select("label", "first"), "first")
    ids = scratch.table(own.join(first, "label", "left").select("tid", F.coalesce("first", "least")["key"].alias("class_id")), "ids")
    scratch.drop(own, first)
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), text_id(F.col(f"`{text}`")).alias("tid"))
    return rows.join(ids, "tid").select("row", "class_id")


def one_of_each(documents: DataFrame, text: str = "text", key: str = "doc_id", **how) -> DataFrame:
    """One row of each class, the one of least key (null keys last; of equal keys, by a hash of the text)."""
    labels, _ = near_duplicates(documents, text, **how)
    own = _least_by_text(documents, text, key, labels)
    winners = own.groupBy("label").agg(F.min(F.struct("least", "tid")).alias("w")).select("w.tid")
    # copies are one row before rows are dealt out; of copies with one key any row will do, as they differ in other columns at most
    k = F.col("row")[key]
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), text_id(F.col(f"`{text}`")).alias("tid"))
    best = rows.groupBy("tid").agg(F.min_by("row", F.struct(k.isNull(), k, F.xxhash64("row"))).alias("row"))
    return best.join(winners, "tid", "left_semi").select("row.*")
