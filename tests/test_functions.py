"""Exact cases of cleaning, context and description functions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import cleaning as C
from corpusloom.functions import context as X
from corpusloom.functions import describe as D
from corpusloom.functions import phrases as P
from corpusloom.plans import extended
from corpusloom.plans import queries as library


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "text, cleaned",
    [
        (None, ""),
        ("", ""),
        ("Keep this.\n*This document is uncontrolled when printed.*\nAnd this.", "Keep this.\n\nAnd this."),
        ("A\nPage 5 of 25\nB\nPrinted on: 12/31/2024", "A\n\nB"),
        ("Care Manual\nText\nCare Manual", "Text"),
        ("a   b\t\tc  \n\n\n\n\nd", "a b c\n\nd"),
        ("x\nx\nx\nx\nlast", "last"),
        ("x\nx\nx\nlast", "x\nx\nx\nlast"),
    ],
)
def test_clean(spark, text, cleaned):
    assert one(spark, text, C.clean) == cleaned


def test_clean_is_idempotent_on_white_space(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").select(C.normalize_whitespace(F.col("text")).alias("t"))
    assert d.where(C.normalize_whitespace(F.col("t")) != F.col("t")).count() == 0


def test_validation(spark):
    rows = spark.createDataFrame([("", ""), ("a " * 40, "a a"), ("w " * 12, "w " * 12), ("one two", "one two")], "a string, b string")
    assert [r[0] for r in rows.select(C.validate_cleaning(F.col("a"), F.col("b"))).collect()] == ["valid", "word_loss", "valid", "too_short"]


def test_ngrams(spark):
    assert one(spark, "alpha beta gamma", C.ngrams) == ["alpha beta", "beta gamma", "alpha beta gamma"]
    assert one(spark, "", C.ngrams) == []


@pytest.mark.parametrize(
    "name, index",
    [
        ("CARE1-P10.01-T3 Form.docx", "CARE1-P10.01-T3"),
        ("ADM2-P05.02 Policy.pdf", "ADM2-P05.02"),
        ("IPC1-A01.01 x.docx", "IPC1-A01.01"),
        ("regular_file_name.pdf", None),
        ("INVALID-P10.01 Test.docx", None),
    ],
)
def test_document_index(spark, name, index):
    assert one(spark, name, X.document_index) == index


@pytest.mark.parametrize("name, kind", [("Policy Manual", "policy"), ("Form Template", "form"), ("Training Guide", "guide"), ("Process Flowchart", "flowchart"), ("Quick Reference", "reference"), ("Regular Document", None)])
def test_document_type(spark, name, kind):
    assert one(spark, name, X.document_type) == kind


def test_context(spark):
    c = one(spark, "/test/mirror/Care/Section/CARE1-P10.01 Informed Treatment Consent Form.docx", lambda p: X.context(p, "/test/mirror"))
    assert (c.policy_manual, c.policy_acronym, c.section, c.document_index, c.is_additional_resource) == ("Care", "CARE", "Section", "CARE1-P10.01", False)
    c = one(spark, "/test/mirror/Infection Prevention and Control/Additional Resources/Staff follow-up form.docx", lambda p: X.context(p, "/test/mirror"))
    assert (c.policy_acronym, c.is_additional_resource, c.document_index, c.hierarchy_path) == ("IPC", True, None, ["Infection Prevention and Control", "Additional Resources"])


def test_synthetic_index(spark):
    rows = spark.createDataFrame([("CARE", True, 5), ("CARE", False, 12), (None, False, 1234)], "a string, b boolean, n int")
    assert [r[0] for r in rows.select(X.synthetic_index(F.col("a"), F.col("b"), F.col("n"))).collect()] == ["CARE-ADDL-005", "CARE-MISC-012", "UNK-MISC-1234"]


def test_forms(spark):
    assert one(spark, "Data Format Notice.pdf", D.form_type) == "poster"
    assert one(spark, "CARE1-P10.01 Blood_Log.docx", D.form_title) == "blood log"
    c = lambda p: X.context(p, "/m")
    assert one(spark, "/m/Care/Medication Safety/Check.pdf", lambda p: D.form_purpose(c(p))) == "resident care and medication management"
    assert one(spark, "/m/x.pdf", lambda p: D.form_purpose(X.context(p, "/m"))) == "organizational procedures"
    assert one(spark, "/m/Care/S/CARE1-P1.1 form.pdf", lambda p: D.confidence(c(p), F.lit(500_000))) == pytest.approx(0.95)


def test_literals():
    assert C.literal(r"Page \d+ of \d+") == "Page " and C.literal(r"https?://[^\s]+") == "http" and C.literal(r"^\d+$") == "" and C.literal(r"a|b") == ""
    assert C.literal(r"No\. (?:x|y) end\.?") == "" or "No. " in C.literal(r"No\. (?:xy) end\.?")


def test_guards_change_nothing(spark):
    """Every pattern is looked for wherever it may match, odd letters included."""
    texts = ["EFFECTIVE DATE: 1/2/2020 x", "Thi\u017f document i\u017f uncontrolled when printed.", "PAGE 3 of 9 Page 3 of 9", "rev\u0131sion: 1.2 and REV\u0130SION: 3", "a https://x.y z", "|  |", "nothing"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")

    def plain(t, patterns, flags):
        for p in patterns:
            t = F.regexp_replace(t, F.lit(f"(?Ud{flags}){p}"), F.lit(""))
        return t

    from corpusloom import config

    t = F.col("t")
    got = rows.select(C.remove_disclaimers(t), plain(t, config.Organisation().disclaimers(), "is"), C.remove_noise(t), plain(t, config.NOISE_PATTERNS, "m")).collect()
    assert all(r[0] == r[1] and r[2] == r[3] for r in got)


def test_removed_patterns_by_name(spark):
    text = "Care Manual\nSame line that is long\n" + "Same line that is long\n" * 4 + "Legal matters\nbody"
    r = spark.createDataFrame([(text,)], "t string").select(C.header_counts(F.col("t")).alias("c"), C.clipped(C.header_counts(F.col("t"))).alias("m")).first()
    assert [(c.kind, c["count"]) for c in r.c] == [("repeated_line", 5), ("header_footer", 1), ("header_footer", 1)]
    assert r.m["repeated_line_Same line that is lo..."] == 5 and len(r.m) == 3


def test_phrases(spark):
    rows = spark.createDataFrame([(1, "alpha beta gamma alpha beta gamma"), (2, "alpha beta gamma")], "k long, t string")
    counts = {r.phrase: (r.occurrences, r.documents) for r in C.phrase_counts(rows, F.col("t"), "k").collect()}
    assert counts["alpha beta gamma"] == (3, 2) and counts["alpha beta"] == (3, 2)
    frame = C.phrase_counts(rows, F.col("t"), "k")
    assert [r.phrase for r in C.frequent_noise(frame, 4, 0).collect()] == ["alpha beta", "alpha beta gamma", "beta gamma"]
    assert C.frequent_noise(frame, 3, 1.0, by="documents").count() == 0


def _counted(rows, low=10, high=100):
    """Phrases with occurrences and documents, by brute force."""
    times, docs = {}, {}
    for k, t in rows:
        w = [x for x in re.split(f"[{C.SPACES}]+", t or "") if x]
        for n in range(2, 6):
            for i in range(len(w) - n + 1):
                p = " ".join(w[i : i + n])
                if low <= len(p) <= high:
                    times[p] = times.get(p, 0) + 1
                    docs.setdefault(p, set()).add(k)
    return {p: (n, len(docs[p])) for p, n in times.items()}


@pytest.fixture
def phrase_rows(monkeypatch):
    """Repeated keys, null texts, odd spaces; several flushes and buckets."""
    monkeypatch.setattr(P, "FLUSH_WORDS", 20)
    monkeypatch.setattr(P, "BUCKET_CHARS", 300)
    rng = random.Random(1)
    some, spaces = ["alpha", "be", "gamma-ray", "d", "\xe9ழx", "longword" * 3, "q\x1cr"], [" ", "\n", " \t ", "\xa0", " "]
    return [(None if i % 17 == 0 else i % 40 - 3, None if i % 13 == 0 else "".join(rng.choice(some) + rng.choice(spaces) for _ in range(rng.choice([0, 1, 2, 3, 5, 30])))) for i in range(90)]


def _documents(spark, rows, monkeypatch):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(library, "_docs", lambda spark, sf: frame)
    return _counted([r for r in rows if r[0] is not None and r[0] >= 0])


def test_frequent_noise_of_packed_phrases(spark, phrase_rows, monkeypatch):
    want = _documents(spark, phrase_rows, monkeypatch)
    got = {r.phrase: (r.occurrences, r.documents) for r in library.queries()["frequent_noise"](spark, "").collect()}
    assert got == {p: x for p, x in want.items() if x[1] >= 1}


def test_frequent_occurrences_of_packed_phrases(spark, phrase_rows, monkeypatch):
    want = _documents(spark, phrase_rows, monkeypatch)
    got = {r.phrase: (r.occurrences, r.documents) for r in extended.queries()["frequent_noise_occurrences"](spark, "").collect()}
    assert got == {p: x for p, x in want.items() if x[0] >= 45}


def test_most_common_of_packed_phrases(spark, phrase_rows, monkeypatch):
    want = _documents(spark, phrase_rows, monkeypatch)
    got = [tuple(r) for r in extended.queries()["phrases_by_count"](spark, "").collect()]
    assert got == sorted(((p, *x) for p, x in want.items()), key=lambda x: (-x[1], x[0]))[:200]


def test_histogram_of_packed_phrases(spark, phrase_rows, monkeypatch):
    want = {}
    for p, (n, d) in _documents(spark, phrase_rows, monkeypatch).items():
        a = want.setdefault(n, [0, 0, 0])
        want[n] = [a[0] + 1, a[1] + d, a[2] + len(p)]
    assert {r.occurrences: [r.phrases, r.documents, r.characters] for r in library.queries()["ngram_frequency"](spark, "").collect()} == want
