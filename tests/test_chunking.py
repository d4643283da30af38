"""The cut loop, its properties, and what is derived from chunks."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions import context as X
from corpusloom.operators import chunking as K


def test_tokens(spark):
    rows = spark.createDataFrame([("This is a test sentence with eight tokens",), ("",), ("   ",), (None,)], "t string")
    assert [r[0] for r in rows.select(K.token_count(F.col("t"))).collect()] == [8, 0, 0, 0]
    parts = rows.limit(1).select(K.split_by_tokens(F.col("t"), 5)).first()[0]
    assert parts == ["This is a test sentence", "with eight tokens"]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab .!?\n", max_size=3000))
def test_lossless_cuts_cover_the_text(text):
    cuts = K.cut(text, K.Cuts(size=40, overlap=5, minimum=10))
    assert [c[0] for c in cuts] == list(range(len(cuts)))
    assert all(c[1] and c[2] < c[3] <= len(text) and 0 <= c[4] <= 1 for c in cuts)
    seen = set()
    for c in cuts:
        seen.update(range(c[2], c[3]))
    end = max((c[3] for c in cuts), default=0)
    assert not text[end:].strip()


def test_nulls_and_blanks_give_no_chunks(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "  \n"), (4, "Some text.")], "doc_id long, text string")
    assert [(r.doc_id, r.chunk_text) for r in K.chunk(rows).collect()] == [(4, "Some text.")]


def test_sections_tables_and_hash(spark):
    text = "# One\nx\n## Two\n### Three\n| a | b |\n|---|---|\n| 1 | 2 |\nend"
    rows = spark.createDataFrame([(1, text)], "k long, t string")
    assert sorted((r.level, r.priority) for r in K.section_boundaries(rows, "k", "t").collect()) == [(1, 9), (2, 8), (3, 7)]
    (b,) = K.table_boundaries(rows, "k", "t").collect()
    assert text[b.start : b.end] == "| a | b |\n|---|---|\n| 1 | 2 |"
    assert len(rows.select(K.chunk_hash(F.col("t"))).first()[0]) == 16


def test_preservation(spark):
    row = spark.range(1).select(K.preservation(F.array(*map(F.lit, (0, 50, 40, 90, 85, 135))), F.array(*map(F.lit, (25, 50, 90, 120)))))
    assert row.first()[0] == 1.0


def test_chunker_in_sql(spark):
    K.register_chunker(spark, "cut_up", K.Cuts(size=40, overlap=5, minimum=10))
    rows = spark.sql("SELECT c.* FROM (SELECT repeat('A sentence of words. ', 40) AS t) d, LATERAL cut_up(d.t) c").collect()
    assert len(rows) > 2 and rows[0].chunk_index == 0


def test_headings_and_tables_win_over_sentences():
    text = "A sentence here. " * 10 + "\n# Head\n" + "More words follow. " * 10 + "\n| a | b |\n|---|---|\n| 1 | 2 |\nEnd of it. " + "Tail words. " * 8
    found = K.places_of(text, text)
    head, start = text.index("# Head"), text.index("| a")
    assert found[head] == 9 and found[start] == 8 and found[text.index("End") - 1] == 8
    cuts = K.cut(text, K.Cuts(size=40, overlap=5, minimum=10))
    assert cuts[0][3] == head
    assert K.cut(text, K.Cuts(size=40, overlap=5, minimum=10, families=("sentence", "paragraph")))[0][3] != head
    assert K.cut("plain words " * 40, K.Cuts(size=40, overlap=5, minimum=10), "# elsewhere\n" + "x" * 150 + "\n# here")[0][3] == 163


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab .!?\n", max_size=300), min_size=1, max_size=4))
def test_boundary_columns_equal_the_loops(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    got = {r.k: set(r.bounds) for r in K.boundaries(rows, "k", "t").collect()}
    assert got == {i: set(K.places_of(t, t)) for i, t in enumerate(texts)}


def test_running_sums(spark):
    rows = spark.createDataFrame([(list(range(n)),) for n in (0, 1, 5, 256, 257, 1000)], "x array<int>")
    for r in rows.select("x", K.running_sums(F.col("x"), 7).alias("s"), K.running_sums(F.col("x")).alias("t")).collect():
        assert r.s == r.t == [sum(r.x[: i + 1]) for i in range(len(r.x))]


def test_documents_without_content(spark):
    rows = spark.createDataFrame([(1, "  x ", "/r/Care/Part/CARE1-P10.01 Checklist.pdf"), (2, None, "/r/a/b.pdf"), (3, "Enough of a text to cut. " * 9, "/r/a/b.pdf")], "doc_id long, text string, path string")
    ctx = X.context(F.col("path"), "/r")
    got = {r.doc_id: r for r in K.chunk_documents(rows, ctx, path=F.col("path")).collect()}
    assert set(got) == {1, 2, 3}
    one = got[1]
    assert one.chunk_text.endswith("Filename: CARE1-P10.01 Checklist.pdf Document ID: CARE1-P10.01") and one.chunk_markdown.startswith("# CARE1-P10.01 Checklist.pdf\n\n")
    assert one.context_metadata.synthetic_description and one.context_metadata.document_type == "checklist" and one.char_end == len(one.chunk_text)
    assert not got[3].context_metadata.synthetic_description and got[3].context_metadata.generated_keywords is None
    assert {r.doc_id for r in K.chunk_documents(rows, ctx, synthetic=False).collect()} == {3}


def test_tokenizers(spark):
    rows = spark.createDataFrame([(1, "One, two three"), (2, None), (3, "")], "k long, t string")
    got = {r.k: (r.tokens, r.parts) for r in K.tokenized(rows, "k", "t", K.WordTokenizer(), 3).collect()}
    assert got == {1: (4, ["One , two", "three"]), 2: (0, [""]), 3: (0, [""])}
    public_tokenizers = pytest.importorskip("public_tokenizers")
    own = K.FileTokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    r = K.tokenized(rows.where("k = 1"), "k", "t", own, 2).first()
    assert r.tokens == len(own.ids("One, two three")) and "".join(r.parts).replace(" ", "") == "One,twothree"


def test_shares_are_rounded_as_in_the_sql(spark):
    """Shares whose seventh digit is a five, such as 639 of 640."""
    import duckdb

    from corpusloom.plans import queries as library

    pairs = [(k, n) for n in (640, 320, 192, 448, 832, 128) for k in range(1, n)]
    rows = spark.createDataFrame(pairs, "k long, n long").select("k", "n", library._six(F.col("k") / F.col("n")).alias("x")).collect()
    want = {(k, n): x for k, n, x in duckdb.sql("SELECT k, n, round(k / n, 6) FROM (VALUES " + ", ".join(map(str, pairs)) + ") v(k, n)").fetchall()}
    assert all(r.x == want[r.k, r.n] for r in rows)
