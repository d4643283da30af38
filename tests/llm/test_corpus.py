"""The corpus operators against brute-force versions, and on nulls, empty tables, ties and clashing columns."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import bwt, decontam, langid, lines, minhash, mixing, repeats, sharding, sketch, substring, suffix, tokens
from corpusloom.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PHRASE = "the quick brown fox jumps over the lazy dog while many small birds sing in tall green trees near " * 4


def corpus():
    """Copies, near copies, shared passages, nulls, blanks, repeated rows and odd characters."""
    rng = random.Random(3)
    words = [w + x for w in "alpha beta gamma delta omega ñandú über école kilo lima".split() for x in ("", "s", "ing", "ed", ".", ",")]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = [text(rng.randint(3, 150)) for _ in range(40)]
    docs += [docs[0]] * 3 + [docs[1][:-9] + " changed"] + [text(20) + " " + PHRASE + text(20) for _ in range(4)]
    docs += [None, "", " ", "\n\n", "12345 !!", "a\x00b \U0001f600 é", "x" * 3000, "word " * 400, "Line one\nShared line\nlast", *["Shared line \nonly %d" % i for i in range(12)]]
    rows = [(i, t, ("en", "fr", None)[i % 3], ("a", "b", None, "c")[i % 4], 0) for i, t in enumerate(docs)]
    return [*rows, rows[5], rows[5]]  # repeated rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def listed(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


# ---------------------------------------------------------------- suffix structures


@pytest.mark.parametrize("n, sigma", [(0, 2), (1, 2), (60, 2), (400, 4), (900, 40)])
def test_suffix_array_and_index(n, sigma):
    s = np.random.default_rng(n).integers(0, sigma, n)
    assert suffix.suffix_array(s, sigma).tolist() == sorted(range(n), key=lambda i: s[i:].tolist())
    if n:
        index = suffix.FMIndex(s, sigma, 4)
        for length in (1, 2, 4):
            patterns = np.random.default_rng(length).integers(0, sigma, (25, length))
            for p, a, b in zip(patterns, *index.search(patterns), strict=True):
                assert sorted(index.locate(np.arange(a, b)).tolist()) == [i for i in range(n - length + 1) if (s[i : i + length] == p).all()]


def test_merged_transforms_equal_one_sort():
    rng = np.random.default_rng(1)
    parts = [[rng.integers(1, 4, rng.integers(1, 40)) for _ in range(6)] for _ in range(2)]
    flat = [np.concatenate([np.append(x, 0) for x in p]) for p in parts]
    merged, lcp = bwt.merge(bwt.transform(flat[0]), bwt.transform(flat[1], len(flat[0])), 6)
    position = merged.position
    text = np.concatenate(flat)
    key = lambda i: text[i : i + 1 + int(np.argmax(text[i:] == 0))].tolist()
    keys = [key(i) for i in position]
    cut = [k[:6] for k in keys]
    assert cut == sorted(cut)
    for j in range(1, len(keys)):
        a, b = keys[j - 1], keys[j]
        common = next((m for m in range(6) if m >= min(len(a), len(b)) or a[m] != b[m] or a[m] == 0), 6)
        assert lcp[j] == common


# ---------------------------------------------------------------- 1


def test_language(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    found = langid.identify(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert right[0] > 0.95 and 0 <= right[1] <= right[2] <= 1
    ids = {r.doc_id for r in found.collect()}
    assert ids == {r.doc_id for r in d.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}


def test_language_code_lengths_are_a_distribution():
    rng = np.random.default_rng(0)
    counts = rng.poisson(0.3, 5**3)
    p = np.exp2(-langid.code_lengths(counts, 5, 2).reshape(-1, 5).astype(float))
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)


def test_language_codes_every_byte():
    """Bits of texts equal those of the dense table over 256 bytes, and rare scripts are told apart."""
    greek, hebrew, plain = "λόγος και νόμος ", "שלום ורב טוב ", "Plain words % & * and 123 more $ "
    counts = {}
    for name, text in (("el", greek * 3), ("en", plain * 200), ("he", hebrew * 3)):
        counts[name] = np.unique(langid._grams(text.encode(), 1), return_counts=True)
    model = langid.model_of(counts, 1)
    texts = ["λόγος", "שלום", "Jolly words, üß ", "νב k9"]
    dense = []
    for name in model.languages:
        c = np.zeros(256**2)
        c[counts[name][0].astype(int)] = counts[name][1]
        dense.append(langid.code_lengths(c, 256, 1))
    for t, found in zip(texts, langid._bits(model, [langid._grams(t.encode(), 1) for t in texts]), strict=True):
        want = [sum(float(d[g]) for g in langid._grams(t.encode(), 1).astype(int)) for d in dense]
        assert np.allclose(found, want, rtol=1e-4)
    assert langid.score(model, texts[:2])[0] == ["el", "he"]
    assert np.allclose(langid.score(model, texts, 3)[2], langid.score(model, texts)[2])


def test_language_learns_the_most_frequent_labels(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 2)
    monkeypatch.setattr(langid, "ALL_DOCS", 20)
    rows = [(i, ("plain words in a row" if i % 2 else "mots simples en rang été"), ("en", "fr")[1 - i % 2]) for i in range(60)] + [(100 + i, "rare", f"x{i}") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_on(docs)
    assert model.languages == ("en", "fr")
    assert {r.lang_pred for r in langid.predict(docs, model, F.col("text"), F.col("doc_id")).collect()} == {"en", "fr"}


def test_language_stage_rejects_what_is_foreign(spark, sf):
    """Texts of an unlearned language, an unlearned script and no language go; learned ones stay, short ones too."""
    import corpus_pipeline as P

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    foreign = ["Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä. " * 3]
    foreign += ["Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью. " * 3, "12 34 !!", None]
    extra = spark.createDataFrame([(10**6 + i, t, None, "x", 0) for i, t in enumerate(foreign)], SCHEMA)
    kept = P.language(spark, docs.union(extra), sf).select("doc_id", "lang").collect()
    ids = {r.doc_id for r in kept}
    assert not ids & set(range(10**6, 10**6 + 4)) and all(r.lang for r in kept)
    clean = docs.where("length(text) > 0").count()
    assert len(ids) >= 0.99 * clean


def test_language_edges(docs, rows, empty):
    found = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert len(found) == len({r[0] for r in rows})
    for i, t, *_ in rows:
        if t is None or not any(c.isalpha() for c in t):
            assert (found[i].lang_pred, found[i].score) == ("und", 0.0)
    assert langid.identify(empty).count() == 0
    assert {r.lang_pred for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


# ---------------------------------------------------------------- 2


def test_targets():
    assert mixing.targets([("b", 100), ("a", 100), (None, 100)], (3, 1, 2), 1.5, 2) == {"a": 200.0, "b": 250 / 3, None: 500 / 3}
    assert mixing.targets([], (3, 1, 2), 1.5, 2) == {}


def test_knapsack_is_exact():
    rng = random.Random(0)
    for _ in range(60):
        lengths = sorted(rng.sample(range(1, 30), 5))
        counts = [rng.randint(0, 4) for _ in lengths]
        goal = rng.randint(0, 120)
        sums = {0}
        for n, c in zip(lengths, counts, strict=True):
            sums = {s + n * k for s in sums for k in range(c + 1)}
        taken = mixing.knapsack(goal, lengths, counts)
        assert all(t <= c for t, c in zip(taken, counts, strict=True))
        assert sum(n * t for n, t in zip(lengths, taken, strict=True)) == max(s for s in sums if s <= goal)
        assert sum(n * t for n, t in zip(lengths, mixing.fit(goal, lengths, counts, 50), strict=True)) <= goal


def test_mix(docs, rows, empty):
    mixed = mixing.mix_sources(docs.withColumns({"size": F.lit(1), "taken": F.lit("x"), "salt": F.lit(2)}))
    got = mixed.select("row.doc_id", "row.source", "size", "source_size", "target", "taken").collect()
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for r in got:
        assert r.taken % max(r.size, 1) == 0 and 0 <= r.taken <= 2 * r.size
        by[r.source].append(r)
    longest = max(r.size for r in got)
    for group in by.values():
        assert sum(r.size for r in group) == group[0].source_size
        assert group[0].target - longest <= sum(r.taken for r in group) <= group[0].target + 1
    again = mixing.mix_sources(docs.repartition(5)).select("row.doc_id", "size", "taken")
    assert listed(again, "doc_id", "size", "taken") == sorted([(r.doc_id, r.size, r.taken) for r in got], key=str)
    assert mixing.mix_sources(empty).count() == 0
    sizes = {r[0]: len((r[1] or "").split()) for r in rows if not r[1] or "\x1c" not in r[1]}
    assert all(r.size == sizes[r.doc_id] for r in got)


def test_mix_takes_what_the_programme_says(spark):
    """Of each source and length the first rows by the seeded hash are taken once more, and their words reach the most
    that any choice of documents can, below the target."""
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.choice([1, 2, 3, 7, 19])), "abcde"[i % 5] if i % 11 else None) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_sources(docs).withColumn("draw", F.xxhash64(F.lit(20), "row.doc_id", "row.text")).collect()
    for source in {r.row.source for r in got}:
        own = [r for r in got if r.row.source == source]
        whole, budget = divmod(int(round(own[0].target)), own[0].source_size)
        by = collections.defaultdict(list)
        for r in own:
            by[r.size].append((r.draw, r.times - whole))
        for group in by.values():
            extra = [t for _, t in sorted(group)]
            assert extra == sorted(extra, reverse=True) and set(extra) <= {0, 1}
        sums = {0}
        for r in own:
            sums |= {x + r.size for x in sums}
        assert sum(r.taken for r in own) == whole * own[0].source_size + max(x for x in sums if x <= budget)


# ---------------------------------------------------------------- 3 and 9


def windows_gone(sequences, window):
    """Brute force: which units lie in a window that starts more than once in all."""
    seen = collections.Counter(tuple(s[i : i + window]) for s in sequences for i in range(len(s) - window + 1))
    out = []
    for s in sequences:
        gone = [False] * len(s)
        for i in range(len(s) - window + 1):
            if seen[tuple(s[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append(gone)
    return out


@pytest.mark.parametrize("window", [5, 35])
def test_substring_dedup(docs, rows, window):
    split = [(r[1] or "").encode().split() for r in rows]
    want = []
    for r, s, g in zip(rows, split, windows_gone(split, window), strict=True):
        kept = b" ".join(w for w, x in zip(s, g, strict=True) if not x)
        want.append((r[0], len(s), sum(g), hashlib.sha256(kept).hexdigest()))
    got = substring.remove_repeats(docs.withColumn("k1", F.lit(1)), window=window)
    assert listed(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(want, key=str)


@pytest.mark.parametrize("window", [20, 200])
def test_suffix_dedup(docs, rows, window, monkeypatch):
    monkeypatch.setattr(bwt, "GRAM", 8)
    data = [(r[1] or "").encode() for r in rows]
    want = []
    for r, s, g in zip(rows, data, windows_gone(data, window), strict=True):
        spans = sum(1 for i, x in enumerate(g) if x and (i == 0 or not g[i - 1]))
        want.append((r[0], len(s), sum(g), spans, hashlib.sha256(bytes(b for b, x in zip(s, g, strict=True) if not x)).hexdigest()))
    got = bwt.remove_repeats(docs, window=window).withColumn("n_spans", F.size("spans"))
    assert listed(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(want, key=str)


def test_long_texts_go_in_blocks(spark, monkeypatch):
    rng = random.Random(1)
    words = [f"w{rng.randint(0, 10**6)}" for _ in range(3000)]
    text = " ".join(words + words[100:200])
    monkeypatch.setattr(repeats, "BLOCK", 64)
    rows = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert substring.remove_repeats(rows).first().n_removed == 200


def expected_words(rows, window):
    split = [(r[1] or "").encode().split() for r in rows]
    gone = windows_gone(split, window)
    return sorted(((r[0], len(s), sum(g), hashlib.sha256(b" ".join(w for w, x in zip(s, g, strict=True) if not x)).hexdigest()) for r, s, g in zip(rows, split, gone, strict=True)), key=str)


def expected_bytes(rows, window):
    data = [(r[1] or "").encode() for r in rows]
    gone = windows_gone(data, window)
    return sorted(((r[0], len(s), sum(g), hashlib.sha256(bytes(b for b, x in zip(s, g, strict=True) if not x)).hexdigest()) for r, s, g in zip(rows, data, gone, strict=True)), key=str)


def hot_rows(rng, n=60):
    """Many equal rows, null ids, one passage between ever other contexts, and a text against weak hashes."""
    word = lambda: f"w{rng.randint(0, 10**6)}"
    passage = " ".join(word() for _ in range(50))
    rows = [(i, " ".join([*(word() for _ in range(30)), passage, *(word() for _ in range(30))])) for i in range(n)]
    rows += [(None if i % 2 else 7, passage + " and its tail") for i in range(40)]
    letters = "a"
    for _ in range(11):  # 2048 letters in the order of Thue and Morse, and their opposite
        letters += letters.translate(str.maketrans("ab", "ba"))
    other = letters.translate(str.maketrans("ab", "ba"))
    rows += [(1000, " ".join([letters] * 40)), (1001, " ".join([other] * 39)), (1002, letters), (1003, other)]
    return rows


@pytest.mark.parametrize("group_bytes", [1, 3000, 1 << 30])
def test_groups_of_any_size(spark, monkeypatch, group_bytes):
    """Large groups go from level to level, down to whole windows; results are those of brute force."""
    monkeypatch.setattr(repeats, "GROUP_BYTES", group_bytes)
    monkeypatch.setattr(repeats, "MATCH_BYTES", 5000)
    rows = hot_rows(random.Random(6))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert listed(substring.remove_repeats(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == expected_words(rows, 35)
    assert listed(bwt.remove_repeats(docs.withColumn("tid", F.lit(1))), "doc_id", "n_bytes", "n_removed", "kept_sha256") == expected_bytes(rows, 200)


def test_shards_merge_at_more_than_one_level(monkeypatch):
    rng = np.random.default_rng(9)
    base = rng.integers(97, 100, 400).astype(np.uint8).tobytes()
    rows = []
    for i in range(23):
        a, own = int(rng.integers(0, 300)), rng.integers(97, 100, 30).astype(np.uint8).tobytes()
        body = own + base[a : a + 60] + own[::-1]
        rows.append((1, bytes([i]), 1, body, len(body) - 19, 0))
    want = [np.array(g) for g in windows_gone([r[3] for r in rows], 20)]
    monkeypatch.setattr(bwt, "trimmed", lambda group, window: [(0, r[3]) for r in group])  # these share no run
    for shard in (10**6, 1500, 900, 300, 1):
        for r, got, w in zip(rows, bwt.merging(20, shard)(rows), want, strict=True):
            cover = np.zeros(len(r[3]), dtype=bool)
            for at in np.flatnonzero(got):
                cover[at : at + 20] = True
            assert (cover == w).all()


def test_hasher_of_long_data():
    data = np.random.default_rng(3).integers(0, 256, 200_000).astype(np.uint8)
    twice = repeats.Hasher(np.concatenate([data, data]))
    a = np.arange(0, 190_000, 777)
    assert (twice.of(a, a + 9000) == twice.of(a + 200_000, a + 209_000)).all() and len(set(twice.of(a, a + 9000).tolist())) == len(a)


def test_repeats_empty(empty):
    assert substring.remove_repeats(empty).count() == 0
    assert bwt.remove_repeats(empty).count() == 0


# ---------------------------------------------------------------- 4


def test_hilbert_curve(spark):
    side = 8
    cells = spark.range(side**3).selectExpr("id % 8 AS x", "id div 8 % 8 AS y", "id div 64 AS z")
    got = cells.withColumn("h", sharding.hilbert_index([F.col("x"), F.col("y"), F.col("z")], 3)).orderBy("h").collect()
    assert [r.h for r in got] == list(range(side**3))
    assert all(abs(a.x - b.x) + abs(a.y - b.y) + abs(a.z - b.z) == 1 for a, b in zip(got, got[1:], strict=False))


@pytest.mark.parametrize("bucket_rows", [2, 50_000])
def test_shards(spark, docs, rows, empty, monkeypatch, bucket_rows):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", bucket_rows)
    got = sharding.hilbert_shards(docs.withColumns({"shard": F.lit(1), "cell": F.lit("c")}), 7)
    got = got.withColumns({"ta": F.xxhash64(F.coalesce("row.text", F.lit(""))), "draw": F.xxhash64("row.doc_id", "row.text")}).collect()
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
        text = r.row.text
        assert r.size == len((text or "").encode()) + 1 and r.text_crc32 == zlib.crc32((text or "").encode())
    counts = [len(v) for v in by.values()]
    assert set(by) == set(range(7)) and max(counts) - min(counts) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    # along the shards and slots the cells rise, and equal texts follow each other
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.cell for r in order] == sorted(r.cell for r in got)
    texts = [r.row.text or "" for r in order]
    assert sum(a != b for a, b in zip(texts, texts[1:], strict=False)) == len(set(texts)) - 1
    if bucket_rows > len(rows):
        assert [(r.cell, r.ta, r.draw) for r in order] == sorted((r.cell, r.ta, r.draw) for r in got)
    assert sharding.hilbert_shards(empty).count() == 0


def test_shards_cut_compact_boxes(spark, tmp_path):
    """Files by shard are what readers can skip: each holds a small part of every dimension."""
    rng = random.Random(2)
    rows = [(i, f"{i} " + "x" * int(2 ** rng.uniform(0, 12)), rng.choice(["de", "en", "fr", "sv"]), rng.choice("abcd")) for i in range(2000)]
    sharded = sharding.hilbert_shards(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), 16)
    sharding.write_shards(sharded, str(tmp_path / "shards"))
    files = spark.read.parquet(str(tmp_path / "shards"))
    spans = files.groupBy("shard").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.countDistinct("lang").alias("langs"), F.countDistinct("source").alias("sources")).collect()
    asked = [(lang, lo) for lang in ("de", "en", "fr", "sv") for lo in range(0, 2000, 250)]
    read = 0
    held = {r["shard"]: {x.lang for x in files.where(F.col("shard") == r["shard"]).select("lang").distinct().collect()} for r in spans}
    for lang, lo in asked:
        read += sum(lang in held[r["shard"]] and r.a < lo + 250 and r.b >= lo for r in spans)
    assert read / (len(asked) * 16) < 0.4  # shards by chance would all be read
    own = [r.slot for r in files.where("shard = 3").select("slot").collect()]
    assert sorted(own) == list(range(125))


def test_shards_of_odd_rows(spark):
    rows = [(None, None, None, None), (None, "", "x", "y"), (5, "same", "a", "b"), (-5, "same", "c", "d"), (1 << 60, "z" * 200_000, "a", None)] * 3
    got = sharding.hilbert_shards(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), 4, carry=["doc_id"]).collect()
    assert len(got) == 15 and {r.row.asDict().keys() == {"doc_id"} for r in got} == {True}
    assert sorted(collections.Counter(r.shard for r in got).values()) == [3, 4, 4, 4]


# ---------------------------------------------------------------- 5


def test_token_files(docs, rows, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = []
    for i, t in sorted(((r[0], r[1]) for r in rows), key=lambda r: r[0]):
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((i, len(ids), zlib.crc32(ids.tobytes())))
    got = sorted(tokens.token_ids(docs, tokenizer_path()).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.n_tokens, r.ids_crc32) for r in got] == want
    assert [r.start for r in got] == [0, *np.cumsum([w[1] for w in want])[:-1].tolist()]
    many = tokens.read_ids(tokens.write_ids(docs.withColumns({"key": F.lit(1), "tie": F.lit("x")}), tokenizer_path(), file_bytes=300))
    assert listed(many, "doc_id", "start", "ids_crc32") == sorted([(r.doc_id, r.start, r.ids_crc32) for r in got], key=str)
    assert tokens.token_ids(empty, tokenizer_path()).count() == 0


def test_token_files_null_keys(spark):
    d = spark.createDataFrame([(None, "a"), (-3, "b c"), (2, None)], "doc_id long, text string")
    assert [(r.doc_id, r.start, r.n_tokens) for r in sorted(tokens.token_ids(d, tokenizer_path()).collect(), key=lambda r: r.start)] == [(None, 0, 2), (-3, 2, 3), (2, 5, 1)]


@pytest.fixture(scope="module")
def wide_tokenizer(tmp_path_factory):
    """Words as ids, in upper and lower case, with ids beyond 16 bits."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    words = {f"w{i}": i for i in range(70_000)} | {"Word": 70_001, "[UNK]": 70_002}
    t = Tokenizer(models.WordLevel(words, unk_token="[UNK]"))
    t.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
    path = tmp_path_factory.mktemp("tokenizer") / "wide.json"
    t.save(str(path))
    return str(path)


def test_other_tokenizers(spark, docs, rows, wide_tokenizer):
    """A tokenizer that is no lower-casing word tokenizer gets whole texts, and wide ids stay whole."""
    import public_tokenizers
    from tokenizers import Tokenizer

    for path in (wide_tokenizer, public_tokenizers.path("byte_bpe_50k.json")):
        assert not tokens.splits_at_words(path)
        tokenizer = Tokenizer.from_file(path)
        own = [(1, "w69999 Word w5 nothing"), (2, "w0")] + [(r[0] + 10, r[1]) for r in rows[:12]]
        want = sorted((i, zlib.crc32(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes())) for i, t in own)
        got = tokens.token_ids(spark.createDataFrame(own, "doc_id long, text string"), path)
        assert listed(got, "doc_id", "ids_crc32") == sorted(want, key=str)
    assert tokens.splits_at_words(tokenizer_path())


def test_an_id_that_does_not_fit_ends_the_job(spark, wide_tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "vocabulary_size", lambda path: 100)
    with pytest.raises(Exception, match="16 bits"):
        tokens.write_ids(spark.createDataFrame([(1, "w69999")], "doc_id long, text string"), wide_tokenizer).count()


def test_encoder_equals_tokenizer():
    from tokenizers import Tokenizer

    rng, alphabet = random.Random(2), "aB'sé \n\t\x1c\x85 ́ÅİΣς日本1.,'ll \U0001f642-"
    texts = ["".join(rng.choice([*alphabet, "<|endoftext|>", "don't"]) for _ in range(rng.randint(0, 40))) for _ in range(800)]
    encoder, tokenizer = tokens.WordEncoder(tokenizer_path(), 2), Tokenizer.from_file(tokenizer_path())
    ids, n = encoder.encode(pa.array(texts))
    parts = np.split(ids, np.cumsum(n)[:-1])
    assert [p.tolist() for p in parts] == [tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]


# ---------------------------------------------------------------- 6


@pytest.mark.parametrize("block, shard", [(500_000, 16 << 20), (1, 500), (3, 16 << 20)])
def test_decontamination(spark, docs, rows, empty, monkeypatch, block, shard):
    """Results are the same in one block of phrases and in many, in one shard of a task and in several."""
    monkeypatch.setattr(decontam, "BLOCK_PHRASES", block)
    monkeypatch.setattr(decontam, "SHARD_BYTES", shard)
    items = [(1, PHRASE[:120]), (2, "Fox JUMPS over"), (3, None), (4, ""), (10, "nothing like this occurs at all in any text here today"), (2, "Fox JUMPS over"), (5, "shared line")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = collections.defaultdict(set)
    for i, t in items:
        w = decontam.phrase_words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k : k + n])].add(str(i))
    want = []
    for r in rows:
        w = decontam.phrase_words(r[1])
        hit, found = [False] * len(w), set()
        for win, owners in windows.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit[k : k + len(win)] = [True] * len(win)
                    found |= owners
        want.append((r[0], len(w), sum(hit), ",".join(sorted(found))))
    got = decontam.find_leaks(docs, bench, F.col("text"), [F.col("doc_id"), F.lit(0).alias("spans0")])
    assert sorted(((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), ",".join(r["items"])) for r in got.collect()), key=str) == sorted(want, key=str)
    assert decontam.find_leaks(empty, bench, F.col("text"), [F.col("doc_id")]).count() == 0
    assert decontam.find_leaks(docs, bench.limit(0), F.col("text"), [F.col("doc_id")]).where("size(spans) > 0").count() == 0


def test_cut_spans():
    assert decontam.cut_spans("One, two three; four.", [(1, 3)]) == "One, ; four."


# ---------------------------------------------------------------- 7


def test_near_duplicates(docs, rows, empty):
    texts = sorted({r[1] or "" for r in rows})
    df = collections.Counter()
    for r in rows:
        h, s, e = minhash._words(r[1])
        df.update(set(h.of(s, e).tolist()))
    words = np.array(sorted(df), dtype=np.uint64)
    idf = words, minhash.inverse_frequencies(len(rows), np.array([df[w] for w in words.tolist()])), float(np.log1p(len(rows)))
    assert all(np.array_equal(a, b) for a, b in zip(idf, minhash.word_weights(docs), strict=True))
    sets = {t: minhash.weighted_set(t, idf) for t in texts}
    parent = {t: t for t in texts}

    def root(t):
        while parent[t] != t:
            t = parent[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[:i]:
            if len(sets[a][0]) and len(sets[b][0]) and minhash.similarity(sets[a], sets[b]) >= 0.8:
                parent[root(a)] = root(b)
    first = {}
    for r in sorted(rows):
        first.setdefault(root(r[1] or ""), r[0])
    got = minhash.classes(docs.withColumn("label", F.lit(1)))
    assert sorted((r.row.doc_id, r.class_id) for r in got.collect()) == sorted((r[0], first[root(r[1] or "")]) for r in rows)
    kept = minhash.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(first.values())
    assert minhash.classes(empty).count() == 0


def test_one_large_group_of_near_copies(spark):
    rng = random.Random(4)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(300)]
    rows = []
    for i in range(60):
        words = base.copy()
        words[rng.randrange(300)] = f"edit{i}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join(base[:60] + [f"x{rng.randint(0, 10**6)}" for _ in range(300)])) for i in range(40)]
    got = minhash.classes(spark.createDataFrame(rows, "doc_id long, text string"))
    ids = {r.row.doc_id: r.class_id for r in got.collect()}
    assert {ids[i] for i in range(60)} == {0} and all(ids[100 + i] == 100 + i for i in range(40))


def test_large_buckets_are_settled_whole(spark, monkeypatch):
    """Every text is in the one bucket of the only band; pairs of copies are apart from all centres."""
    for name, value in (("SMALL", 6), ("TERMS", 400), ("FEW", 2)):
        monkeypatch.setattr(minhash, name, value)
    sign = lambda docs, idf, bands, rows: signatures(docs, idf, bands, rows).withColumn("bands", F.array(F.lit(7).cast("long")))
    signatures = minhash.signatures
    monkeypatch.setattr(minhash, "signatures", sign)
    rng = random.Random(8)
    rows = []
    for i in range(0, 40, 2):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(60)]
        rows += [(i, " ".join(words)), (i + 1, " ".join([*words[:-1], "edit"]))]
    got = minhash.classes(spark.createDataFrame(rows, "doc_id long, text string"), bands=1)
    assert {r.row.doc_id: r.class_id for r in got.collect()} == {i: i - i % 2 for i in range(40)}


def test_recall_of_near_copies(spark):
    """Every row whose id is divisible by 20 against all rows, on a table with large groups of near copies: pairs of a
    similarity of 0.8 or more are in one class."""
    rng = random.Random(21)
    rows, n = [], 0
    for size in (300, 120, 40, *[3] * 40, *[1] * 100):
        base = [f"w{rng.randint(0, 3000)}" for _ in range(rng.randint(60, 200))]
        for _ in range(size):
            words = base.copy()
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = f"e{rng.randint(0, 10**6)}"
            rows.append((n, " ".join(words)))
            n += 1
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ids = {r.row.doc_id: r.class_id for r in minhash.classes(docs).collect()}
    weights = minhash.word_weights(docs)
    sets = {i: minhash.weighted_set(t, weights) for i, t in rows}
    pairs = [(i, j) for i in sets if i % 20 == 0 for j in sets if i != j and minhash.similarity(sets[i], sets[j]) >= 0.8]
    assert len(pairs) > 1000 and np.mean([ids[i] == ids[j] for i, j in pairs]) >= 0.999


def test_sampling_has_no_bias_in_long_texts():
    """Draws come from pools, yet 20,000 shingles estimate as well as few do."""
    rng = np.random.default_rng(4)
    errors = []
    for share in (0.3, 0.5, 0.8, 0.95):
        keys = np.unique(rng.integers(1, 1 << 62, 20_000).astype(np.uint64))
        weights = rng.random(len(keys)) + 0.5
        own = rng.random(len(keys)) < share
        a, b = (keys, weights), (keys[own], weights[own])
        x = minhash.Sampler(600, seed=int(share * 100)).samples([a, b])
        errors.append((x[0] == x[1]).mean() - minhash.similarity(a, b))
    assert abs(np.mean(errors)) < 0.02 and max(map(abs, errors)) < 0.06


def test_sampling_estimates_similarity():
    rng = np.random.default_rng(0)
    keys = rng.integers(1, 1 << 62, 300).astype(np.uint64)
    a = (np.sort(keys), rng.random(300) + 0.5)
    b = (a[0][:240], a[1][:240])
    x = minhash.Sampler(400).samples([a, b])
    assert abs((x[0] == x[1]).mean() - minhash.similarity(a, b)) < 0.08


# ---------------------------------------------------------------- 8


def test_lines(docs, rows, empty):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(str.maketrans(lines.UPPER, lines.LOWER))
    count = collections.Counter(k for r in rows for k in {key(x) for x in (r[1] or "").split("\n")})
    want = []
    for r in rows:
        own = (r[1] or "").split("\n")
        left = [x for x in own if not (len(key(x)) >= 1 and count[key(x)] >= 10)]
        want.append((r[0], len(own), len(own) - len(left), "\n".join(left)))
    got = lines.drop_frequent_lines(docs.withColumns({"lines": F.lit(1), "hash": F.lit(2)}))
    assert listed(got.select("row.doc_id", "n_lines", "n_dropped", "kept"), "doc_id", "n_lines", "n_dropped", "kept") == sorted(want, key=str)
    assert lines.drop_frequent_lines(empty).count() == 0


def test_line_key_strips_its_class_alone(spark):
    """Java's $ stands before a last U+0085, U+2028 or U+2029 too; those are no white space here."""
    lines_ = ["abc \x85", "abc \u2028", "abc\u2029", " abc \t", "abc \x0b\x0c\r", "\x1cabc", "ABC\xa0 "]
    got = [r.k for r in spark.createDataFrame([(x,) for x in lines_], "x string").select(lines.line_key(F.col("x")).alias("k")).collect()]
    assert got == ["abc \x85", "abc \u2028", "abc\u2029", "abc", "abc", "\x1cabc", "abc\xa0"]


@pytest.mark.parametrize("broadcast", [0, 500_000])
def test_lines_of_many_rows(spark, monkeypatch, broadcast):
    """Blank lines, equal rows, null ids and a very long text."""
    monkeypatch.setattr(lines, "BROADCAST_LINES", broadcast)
    rows = [(None, "Head\n\n\nown\n head "), (3, "head\x85\n\nHEAD")] * 12 + [(4, "\n".join(["head", ""] * 3000 + ["tail"])), (5, None), (6, "")]
    got = lines.drop_frequent_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    want = [(None, 5, 3, "\n"), (3, 3, 2, "")] * 12 + [(4, 6001, 3000, "\n" * 3000 + "tail"), (5, 1, 0, ""), (6, 1, 0, "")]
    assert listed(got.select("row.doc_id", "n_lines", "n_dropped", "kept"), "doc_id", "n_lines", "n_dropped", "kept") == sorted(want, key=str)


def test_lines_without_broadcast(docs, monkeypatch):
    want = listed(lines.drop_frequent_lines(docs).select("row.doc_id", "kept"), "doc_id", "kept")
    monkeypatch.setattr(lines, "BROADCAST_LINES", 0)
    assert listed(lines.drop_frequent_lines(docs).select("row.doc_id", "kept"), "doc_id", "kept") == want


# ---------------------------------------------------------------- 10


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_next_document(docs, rows, empty, ranges):
    one = docs.dropDuplicates(["doc_id"])
    own = sorted({(r[0], r[1] or "") for r in rows}, reverse=True)
    want = [(i, t, own[(k + 1) % len(own)][1]) for k, (i, t) in enumerate(own)]
    assert listed(sketch.with_next(one, ranges=ranges), "doc_id", "text", "next_text") == sorted(want, key=str)
    assert sketch.with_next(docs, ranges=ranges).count() == len(rows)
    assert sketch.with_next(empty).count() == 0


def test_next_document_of_many_equal_rows(spark):
    rows = [(None, "a")] * 30 + [(5, "b")] * 30 + [(5, "c"), (-2, None), (1 << 40, "x " * 50_000)]
    got = sketch.with_next(spark.createDataFrame(rows, "doc_id long, text string").withColumns({"part": F.lit(1), "tie": F.lit("t")}), ranges=7).collect()
    own = collections.Counter((r.doc_id, r.text) for r in got)
    assert own == collections.Counter((i, t or "") for i, t in rows)
    after = collections.Counter(r.next_text for r in got)
    assert after == collections.Counter(t or "" for _, t in rows)
    assert {r.next_text for r in got if r.doc_id == -2} == {"a"} and {r.next_text for r in got if r.doc_id is None} == {"a", "x " * 50_000}


def brute_sketch(text, words=5):
    w = re.split(r"[\x20\x09-\x0D]+", text)
    w = [x for x in w if x]
    grams = {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()
    return grams


def test_fingerprint_query(spark, sf):
    """The query on its whole table against the edited texts, and its estimates against the true similarities."""
    from corpusloom.llm.queries import op10_threshold_sketch

    d = sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect(), key=lambda r: -r.doc_id)
    got = {r.doc_id: r for r in op10_threshold_sketch(spark, sf).collect()}
    assert len(got) == len(d)
    errors = []
    for k, (i, t) in enumerate(d):
        nxt, r = d[(k + 1) % len(d)].text, got[i]
        half = len(t) // 2
        new = t[: len(t) - half] + nxt[:half]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        for near, other in ((r.near_edited, new), (r.near_next, nxt)):
            a, b = brute_sketch(t), brute_sketch(other)
            if len(a | b) >= 400:
                errors.append(abs(near - len(a & b) / len(a | b)))
            assert 0 <= near <= 1 and (near == 1 or t != other)
        assert abs(len(r.fingerprint) / 16 - len(brute_sketch(t)) / 4) <= 6 + 4 * len(t) ** 0.5
        # what is kept depends on the hash alone, so a text's own sketch is the same wherever it is met
        assert all(r.fingerprint[j : j + 16] < r.fingerprint[j + 16 : j + 32] or r.fingerprint[j] >= "8" for j in range(0, len(r.fingerprint) - 16, 16))
    assert np.mean(errors) < 0.04 and max(errors) < 0.2


def test_sketches(spark, docs):
    s = docs.select("doc_id", "text", sketch.sketch(F.col("text"), fraction=1.0).alias("all"), sketch.sketch(F.col("text")).alias("low")).collect()
    limit = -(1 << 63) + (1 << 64) // 4
    for r in s:
        assert r.low == [h for h in r["all"] if h <= limit] and r["all"] == sorted(set(r["all"]))
        n = len((r.text or "").split())
        assert len(r["all"]) <= max(0, n - 4) or n < 5 and len(r["all"]) == (n > 0)
    a, b = F.array(*[F.lit(x) for x in (1, 2, 3)]), F.array(*[F.lit(x) for x in (2, 3, 4, 5)])
    r = spark.range(1).select(sketch.likeness(a, b), sketch.containment(a, b), sketch.merge(a, b)).first()
    assert (r[0], r[1], r[2]) == (0.4, pytest.approx(2 / 3), [1, 2, 3, 4, 5])


# ---------------------------------------------------------------- odd tables

CLASHES = "tid row size label bucket h sid k part tie key lines hash gone salt draw lang_pred score bits n_words spans items copies cell shard slot class_id text2 __text".split()
OPERATORS = {
    "1": lambda d, b: langid.identify(d),
    "2": lambda d, b: mixing.mix_sources(d),
    "3": lambda d, b: substring.remove_repeats(d),
    "4": lambda d, b: sharding.hilbert_shards(d),
    "5": lambda d, b: tokens.token_ids(d, tokenizer_path()),
    "6": lambda d, b: decontam.find_leaks(d, b, F.col("text"), [F.col("doc_id")]),
    "7": lambda d, b: minhash.classes(d),
    "8": lambda d, b: lines.drop_frequent_lines(d),
    "9": lambda d, b: bwt.remove_repeats(d),
    "10": lambda d, b: sketch.with_next(d),
}


def odd_rows(spark):
    """Nulls in every column, empty and very long texts, many equal rows, and columns of the operators' own names."""
    rng = random.Random(12)
    long = " ".join(f"w{rng.randint(0, 5000)}" for _ in range(40_000))
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, long, "en", None, 9), (3, long + " more", None, "b", 9), (None, "12 %%", "fr", "b", 1)]
    rows += [(4, "The very same row of a few words, a third of all.", "en", "a", 5)] * 40
    rows += [(100 + i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(50)), rng.choice(["en", "fr"]), "c", 5) for i in range(30)]
    return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in CLASHES})


@pytest.mark.parametrize("name", list(OPERATORS))
def test_odd_tables(spark, name):
    docs = odd_rows(spark)
    bench = spark.createDataFrame([(1, "the very same row of a few words a third of all", 0), (None, None, 0)], "item_id long, text string, items int")
    got = OPERATORS[name](docs, bench).collect()
    assert len(got) == docs.count() == 76
    assert OPERATORS[name](docs.limit(0), bench.limit(0)).count() == 0
    ids = collections.Counter(r.row.doc_id if "row" in r.__fields__ else r.doc_id for r in got)
    assert ids[4] == 40 and ids[None] == 2 and ids[1] == 2


def test_pipeline_of_odd_and_empty_tables(spark, sf):
    import corpus_pipeline as P

    docs = odd_rows(spark)
    for state in (docs, docs.limit(0), docs.withColumn("lang", F.lit(None).cast("string"))):
        n = state.count()
        for name, stage in P.STAGES[:-1]:
            cols = state.columns
            state = P.written(stage(spark, state, sf), name)
            assert state.columns == cols
        assert P.STAGES[-1][1](spark, state, sf).count() == state.count()
        assert bool(n) or not state.count()


# ---------------------------------------------------------------- pipeline


def test_pipeline_stages(spark, sf):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    extra = docs.limit(1).select((F.col("doc_id") + 10**6).alias("doc_id"), F.lit("12 34 !!").alias("text"), "lang", "source", "n_chars")
    state = docs.union(extra).union(docs.limit(2))
    for name, stage in P.STAGES[:-1]:
        before, cols = state.count(), state.columns
        state = P.written(stage(spark, state, sf), name)
        assert state.columns == cols
        if name == "language":
            assert state.count() == before - 1
        if name == "near_duplicates":
            assert minhash.classes(state).where("row.doc_id != class_id").count() == 0
        if name == "decontamination":
            bench = spark.read.parquet(f"{sf}/benchmark.parquet")
            assert decontam.find_leaks(state, bench, F.col("text"), [F.col("doc_id")]).where("size(spans) > 0").count() == 0
    last = P.STAGES[-1][1](spark, state, sf)
    assert last.count() == state.count() and last.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


# ---------------------------------------------------------------- SQL


@pytest.mark.parametrize("name", ["op3_substring_dedup", "op6_benchmark_decontamination", "op8_line_dedup", "op9_suffix_dedup"])
def test_queries_equal_sql(spark, sf, name):
    import duckdb

    from corpusloom.llm import queries as Q

    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    ours, theirs = Q.queries()[name](spark, sf).toPandas(), c.sql(Q.oracle_sql()[name]).df()
    flat = lambda f: sorted(map(str, f[sorted(f.columns)].itertuples(index=False, name=None)))
    assert flat(ours.astype(str)) == flat(theirs.astype(str))


def test_joining_links_leave_the_classes_of_all_links():
    rng = np.random.default_rng(3)
    for _ in range(60):
        n = int(rng.integers(2, 40))
        base = rng.integers(1, 1 << 40, 12).astype(np.uint64)
        sets = []
        for _ in range(n):
            own = np.unique(np.where(rng.random(12) < 0.12, rng.integers(1, 1 << 40, 12), base).astype(np.uint64))
            sets.append((own, np.ones(len(own)) * (1 + own % np.uint64(3))))
        tids = [bytes([i]) for i in range(n)]
        names = [bytes([100 + int(x)]) for x in rng.integers(0, max(2, n // 2), n)]

        def classes(pairs):
            of = {t: m for t, m in zip(tids, names, strict=True)}
            for x, y in pairs:
                a, b = of[x], of[y]
                of = {t: a if m == b else m for t, m in of.items()}
            found = {}
            for t, m in of.items():
                found.setdefault(m, set()).add(t)
            return sorted(map(sorted, found.values()))

        every = [(tids[i], tids[j]) for i in range(n) for j in range(i) if minhash.similarity(sets[i], sets[j]) >= 0.8]
        got = minhash.joining_links(tids, names, sets, 0.8)
        assert all(like >= 0.8 and ((x, y) in every or (y, x) in every) for x, y, like in got)
        assert len(got) < len(set(names)) and classes((x, y) for x, y, _ in got) == classes(every)


def test_language_learns_from_every_document(spark, monkeypatch):
    monkeypatch.setattr(langid, "ALL_DOCS", 2)
    monkeypatch.setattr(langid, "COUNT_GRAMS", 50, raising=False)
    texts = [(f"word{i} of many", ("en", "fr")[i % 2]) for i in range(40)]
    rows = spark.createDataFrame([(t, lang, i) for i, (t, lang) in enumerate(texts)], "text string, lang string, draw long")
    model = langid.train(rows.repartition(3), order=2)
    every = {lang: np.unique(np.concatenate([langid._grams(t.encode(), 2) for t, own in texts if own == lang]), return_counts=True) for lang in ("en", "fr")}
    want = langid.model_of(every, 2)
    assert model.languages == want.languages and all(np.array_equal(a[1], b[1]) for a, b in zip(model.seen, want.seen, strict=True))
