"""State, vectors, reports, sources and streams."""

import hashlib
import io
import json
import zipfile
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import context as X
from corpusloom.operators import collections as O
from corpusloom.operators import embedding as M
from corpusloom.operators import evaluate as V
from corpusloom.operators import run as N
from corpusloom.operators import state as S
from corpusloom.operators import vectors as W
from corpusloom.plans import queries as library
from corpusloom.plans import reports as R
from corpusloom.sources import documents as P
from corpusloom.streaming import files as L


def test_scan(spark):
    state = spark.createDataFrame([("a", "1", "synced"), ("b", "1", "synced"), ("c", "1", "synced"), ("d", "1", "deleted"), ("e", "1", "deleted")], "file_path string, file_hash string, sync_status string")
    listing = spark.createDataFrame([("a", "1"), ("b", "2"), ("d", "1"), ("n", "1")], "file_path string, file_hash string")
    found = {r.file_path: r.change for r in S.scan_diff(listing, state).collect()}
    assert found == {"a": "unchanged", "b": "modified", "c": "deleted", "d": "restored", "n": "new"}
    assert {r.file_path: r.change for r in S.scan_diff(listing, state, restore=False, force=True).collect()}["d"] == "modified"


def test_vectors(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0], 0), (2, [0.0, 1.0], 1), (3, [0.0, 0.0], 1), (4, [1.0, 1.0], 0)], "vec_id long, embedding array<float>, label int")
    assert [r.vec_id for r in W.search(rows, [1.0, 0.0], 2).collect()] == [1, 4]
    assert [r.vec_id for r in W.search(rows, [0.0, 0.0], 2, "euclidean").collect()] == [3, 1]
    assert W.search(rows, [1.0, 0.0], where=W.matches({"label": [0, 1]}, "all")).count() == 0
    assert [r.vec_id for r in W.similar(rows, 1, 1).collect()] == [4]
    q = rows.select(F.col("vec_id").alias("query_id"), "embedding")
    best = {r.query_id: r.vec_id for r in W.batch_search(rows, q, 1).collect()}
    assert best == {1: 1, 2: 2, 3: 1, 4: 4}


def test_silhouette_in_blocks(spark):
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(30, 3)), rng.integers(0, 3, 30)
    rows = spark.createDataFrame([(i, [float(v) for v in x[i]], int(y[i])) for i in range(30)], "vec_id long, embedding array<double>, label int")
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    s = []
    for i in range(30):
        a = d[i][(y == y[i]) & (np.arange(30) != i)].mean()
        b = min(d[i][y == k].mean() for k in set(y) - {y[i]})
        s.append((b - a) / max(a, b))
    assert V.silhouette(rows, block_rows=7).first()[0] == pytest.approx(np.mean(s))


def test_error_classes(spark):
    rows = spark.createDataFrame([("x is not a Word file: y",), ("Failed to parse",), (None,)], "m string")
    assert [r[0] for r in rows.select(R.error_class(F.col("m"))).collect()] == ["Corrupted Word Document", "Document Parsing Error", "Other Error"]


def test_word_files(spark, tmp_path):
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    xml = f'<w:document xmlns:w="{w}"><w:body><w:p><w:pPr><w:pStyle w:val="Heading2"/></w:pPr><w:r><w:t>Head</w:t></w:r></w:p><w:p><w:r><w:rPr><w:b/></w:rPr><w:t>Bold</w:t></w:r><w:r><w:t> text</w:t></w:r></w:p></w:body></w:document>'
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as z:
        z.writestr("word/document.xml", xml)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.DOCX").write_bytes(body.getvalue())
    (tmp_path / "b.doc").write_bytes(b"junk")
    (tmp_path / "c.txt").write_text("no")
    files = P.scan_directory(spark, str(tmp_path))
    assert sorted(r.file_name for r in files.select("file_name").collect()) == ["a.DOCX", "b.doc"]
    parsed = {r.file_path.rsplit("/", 1)[1]: r for r in P.parse_documents(files).collect()}
    assert parsed["a.DOCX"].markdown == "## Head\n\n**Bold** text" and parsed["a.DOCX"].raw_text == "Bold text"
    assert not parsed["b.doc"].parsing_success and "Unsupported" in parsed["b.doc"].error


def test_threshold_gives_every_hit(spark, monkeypatch):
    n = 1_000_002
    rows = spark.range(n).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(0.5)).alias("embedding"), F.lit(1).alias("label"))
    monkeypatch.setattr(library, "_vectors", lambda spark, sf: rows)
    assert library.queries()["vector_threshold"](spark, "").count() == n


def test_measured_quality_follows_the_embeddings(spark, monkeypatch):
    """Two groups, once apart and once the same: only the vectors differ."""
    out = []
    for other in ([0.0, 1.0], [1.0, 0.0]):
        rows = [(i, [1.0, 0.0] if i % 2 else other, i % 2) for i in range(80)]
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label long")
        monkeypatch.setattr(library, "_vectors", lambda spark, sf, frame=frame: frame)
        out.append(library.queries()["quality_scores"](spark, "").first())
    assert [r.semantic_quality for r in out] == [pytest.approx(0.4 + 0.3 + 0.3), pytest.approx(0.2 + 0.3)]


@pytest.mark.parametrize("whole", [0, 1 << 40])
def test_scan_files_hashes_every_file(spark, sf, whole, monkeypatch):
    monkeypatch.setattr(P, "WHOLE_FILE", whole)
    files = {p.name: (p.stat().st_size, hashlib.sha256(p.read_bytes()).hexdigest()) for p in Path(sf).glob("*.parquet")}
    assert {r.file_name: (r.file_size_bytes, r.file_hash) for r in library.queries()["scan_files"](spark, sf).collect()} == files


def test_hash_of_a_file_with_an_odd_name(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(P, "WHOLE_FILE", 0)
    (tmp_path / "a b%20c é.txt").write_bytes(b"text")
    assert [r.file_hash for r in P.hashed_files(spark, str(tmp_path), (".txt",)).collect()] == [hashlib.sha256(b"text").hexdigest()]


def test_table_markdown(spark):
    rows = F.array(F.array(F.lit("a"), F.lit("long one")), F.array(F.lit("xyz")))
    assert spark.range(1).select(P.table_to_markdown(rows)).first()[0] == "| a   | long one |\n| --- | -------- |\n| xyz |          |\n\n"


# Sequences of (kind, hash), and the status, failures and known hash that the rules leave.
SEQUENCES = [
    ([("created", "a"), ("started", None), ("succeeded", None), ("created", "b")], ("synced", 0)),  # known: not created again
    ([("created", "a"), ("succeeded", None), ("modified", "a")], ("synced", 0)),  # the same content
    ([("created", "a"), ("succeeded", None), ("modified", "b")], ("pending", 0)),
    ([("modified", "a")], ("pending", 0)),  # unknown: as if created
    ([("deleted", None)], None),  # unknown: nothing to delete
    ([("created", "a"), ("deleted", None), ("created", "a")], ("pending", 0)),
    ([("created", "a"), ("deleted", None), ("modified", "a")], ("deleted", 0)),
    ([("created", "a"), ("failed", None), ("failed", None)], ("error", 2)),
    ([("created", "a"), ("failed", None), ("succeeded", None), ("failed", None)], ("error", 1)),
    ([("created", "a"), ("what", None), (None, None)], ("pending", 0)),
]


def test_transitions(spark):
    rows, want = [], {}
    for i, (steps, end) in enumerate(SEQUENCES):
        rows += [(len(rows) + j, f"f{i}", kind, digest) for j, (kind, digest) in enumerate(steps)]
        if end:
            want[f"f{i}"] = end
    events = spark.createDataFrame(rows, "event_id long, file_path string, kind string, file_hash string").withColumn("ts", F.col("event_id"))
    got = {r.file_path: (r.sync_status, r.sync_error_count) for r in S.latest_status(events.repartition(5)).collect()}
    assert got == want
    assert S.latest_status(events.limit(0)).count() == 0


def test_stream_equals_batch(spark, tmp_path):
    steps = [s for sequence, _ in SEQUENCES for s in sequence]
    rows = [(i, f"2024-01-01 00:00:{i:02d}", f"f{i % 5}", *steps[(i * 7) % len(steps)]) for i in range(40)]
    schema = "event_id long, ts string, file_path string, kind string, file_hash string"
    for part in range(4):
        spark.createDataFrame(rows[part * 10 : part * 10 + 10], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    out = {}
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    L.monitor(stream, lambda df, _: out.update({r.file_path: r for r in df.collect()}), str(tmp_path / "ck"), once=True).awaitTermination()
    batch = {r.file_path: r.sync_status for r in S.latest_status(spark.createDataFrame(rows, schema)).collect()}
    assert {k: r.sync_status for k, r in out.items() if r.sync_status} == batch
    assert sum(r.events for r in out.values()) == 40


def test_windows(spark):
    rows = spark.createDataFrame([("2024-01-01 01:00:00", "a"), ("2024-01-01 23:00:00", "a"), ("2024-01-02 01:00:00", "a")], "ts string, event_type string").withColumn("ts", F.to_timestamp("ts"))
    assert sorted(r.n for r in L.operations_by_window(rows).collect()) == [1, 2]


def test_event_source_and_monitor(spark, tmp_path):
    folder = tmp_path / "events"
    folder.mkdir()
    lines = [
        {"event_id": 1, "ts": "2024-01-01T00:00:01Z", "file_path": "a.pdf", "kind": "created", "file_hash": "h"},
        {"event_id": 2, "ts": "2024-01-01T00:00:02Z", "file_path": "a.pdf", "dest_path": "b.pdf", "kind": "moved"},
        {"event_id": 3, "ts": "2024-01-01T00:00:03Z", "file_path": "c.txt", "kind": "created"},
        {"event_id": 4, "ts": "2024-01-01T00:00:04Z", "file_path": "x.txt", "dest_path": "y.pdf", "kind": "moved"},
    ]
    (folder / "1.json").write_text("\n".join(map(json.dumps, lines)))
    out = {}
    events = L.event_source(spark, str(folder))
    query = L.monitor(events, lambda df, _: out.update({r.file_path: r.sync_status for r in df.collect()}), str(tmp_path / "ck"))
    query.processAllAvailable()
    assert L.status(query)["running"]
    L.stop(query)
    assert out == {"a.pdf": "deleted", "b.pdf": "pending"} and not L.status(query)["running"]
    (folder / "2.json").write_text(json.dumps(lines[0] | {"event_id": 5, "file_path": "d.docx"}))
    L.monitor(L.event_source(spark, str(folder)), lambda df, _: out.update({r.file_path: r.sync_status for r in df.collect()}), str(tmp_path / "ck"), once=True).awaitTermination()
    assert out == {"a.pdf": "deleted", "b.pdf": "pending", "d.docx": "pending"}  # what was seen counts once


def test_word_tables_and_properties():
    w = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    cell = lambda t: f"<w:tc><w:p><w:r><w:t>{t}</w:t></w:r></w:p></w:tc>"
    xml = f'<w:document xmlns:w="{w}"><w:body><w:tbl><w:tr>{cell("a")}{cell("bb")}</w:tr><w:tr>{cell("ccc")}</w:tr></w:tbl><w:p><w:r><w:t>After</w:t></w:r></w:p></w:body></w:document>'
    core = '<c:coreProperties xmlns:c="x" xmlns:d="y"><d:title>Name</d:title><d:creator>One</d:creator></c:coreProperties>'
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as z:
        z.writestr("word/document.xml", xml)
        z.writestr("docProps/core.xml", core)
    p = P.parse_docx(body.getvalue())
    assert (p.markdown, p.text, p.pages) == ("After\n| a   | bb |\n| --- | -- |\n| ccc |    |\n\n", "After", 1)
    assert json.loads(p.properties) == {"title": "Name", "author": "One", "subject": None, "created": None, "modified": None}


def test_pdf_pages():
    span = lambda t, size=12, flags=0: {"text": t, "size": size, "flags": flags}
    page = {"blocks": [{"image": 1}, {"lines": [{"spans": [span("Title", 18)]}, {"spans": [span("bold", flags=16), span(" "), span("both", flags=18), span("it", flags=2)]}, {"spans": [span("  ")]}]}]}
    md, text = P.page_markdown(page, [[["a", None], ["b", "c"]]], 3)
    assert md == "### Title\n**bold** ***both*** *it*\n| a |   |\n| - | - |\n| b | c |\n\n\n\n---\n*Page 3*\n\n" and text == "Title\nbold both it"
    assert P.page_markdown(page, [], 1, headings=False)[0] == "**bold** ***both*** *it*\n\n---\n*Page 1*\n\n"
    assert P.page_markdown({"blocks": []}, [], 1) == ("", "")


def test_parsers_can_be_added(spark):
    files = spark.createDataFrame([("a.md", b"# x"), ("b.pdf", b"junk"), ("c.odt", b"")], "file_path string, content binary")
    got = {r.file_path: r for r in P.parse_documents(files, P.PARSERS | {".md": lambda c: P.Parsed(c.decode(), "x", 2, "{}")}).collect()}
    assert (got["a.md"].markdown, got["a.md"].page_count, got["a.md"].parsing_success) == ("# x", 2, True)
    assert not got["b.pdf"].parsing_success and got["c.odt"].error == "Unsupported file type: odt"


def test_collections(spark, tmp_path):
    c = O.Collections(spark, f"file://{tmp_path}/c")
    assert c.names() == [] and c.info("a") is None and not c.delete("a")
    assert c.create("a", 2, "dot") and not c.create("a", 3)
    rows = spark.createDataFrame([([1.0, 0.0], "x"), ([0.0, 1.0], "y"), ([0.0, 1.0], "y")], "vector array<float>, name string")
    assert c.add("a", rows).count() == 2 and c.add("a", rows).count() == 2  # ids come from the content
    assert c.info("a") == {"dimension": 2, "metric": "dot", "options": O.DEFAULTS, "vectors": 2}
    with pytest.raises(Exception, match="2 numbers"):
        c.add("a", spark.createDataFrame([([1.0], "z")], "vector array<float>, name string"))
    with pytest.raises(ValueError):
        c.add("none", rows)
    with pytest.raises(ValueError):
        c.create("../up", 2)
    ids = c.read("a").where("name = 'x'").select("id")
    assert not c.update("a", ids.withColumn("vector", F.array(F.lit(1.0), F.lit(1.0))))  # vectors alone
    assert c.update("a", ids.withColumn("name", F.lit("new"))) and [r.name for r in c.search("a", [1.0, 0.0], 1).collect()] == ["new"]
    assert c.remove("a", ids) and c.read("a").count() == 1 and not c.remove("none", ids)
    assert c.create_for("small", 2) and c.cleanup("documents_") == ["a"] and c.names() == ["documents_small"]
    assert O.create_model(c, "dense_qa768") and not O.create_model(c, "dense_qa768") and O.create_model(c, "dense_qa768", force=True) and not O.create_model(c, "x")
    assert O.model_of("documents_dense_qa768") == "dense_qa768" and O.model_of("documents_x") is None and O.model_of("dense_qa768") is None


def test_search_filters(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0], "A", "p", "s"), (2, [0.9, 0.5], "A", "q", "s"), (3, [0.8, 0.9], "B", "p", None)], "vec_id long, embedding array<float>, policy_acronym string, document_type string, section string")
    ids = lambda f: [r.vec_id for r in f.collect()]
    assert ids(W.search_with_context(rows, [1.0, 0.0])) == [1, 2]
    assert ids(W.search_policies(rows, [1.0, 0.0])) == [1, 2, 3]
    assert ids(W.search_with_context(rows, [1.0, 0.0], "A", "", "s", threshold=0.9)) == [1]
    assert ids(W.search_policies(rows, [1.0, 0.0], "B")) == [3]


def test_batch_search_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(50, 4))
    rows = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(50)], "vec_id long, embedding array<double>")
    q = rows.where("vec_id % 5 = 0").withColumnRenamed("vec_id", "query_id")
    best = lambda: sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in W.batch_search(rows, q, 3).collect())
    want = best()
    monkeypatch.setattr(W, "BLOCK_NUMBERS", 9)
    assert best() == want
    assert W.batch_search(rows, q.limit(0), 3).count() == 0


def test_distances_have_bounds(spark, monkeypatch):
    rows = spark.createDataFrame([(i, [float(i % 7), 1.0], i % 3) for i in range(20)], "vec_id long, embedding array<double>, label int")
    assert -1 <= V.centroid_silhouette(rows).first()[0] <= 1 and V.centroid_silhouette(rows.where("label = 0")).first()[0] == 0.0
    monkeypatch.setattr(V, "MOST_BLOCKS", 2)
    with pytest.raises(ValueError, match="centroid"):
        V.silhouette(rows, block_rows=3)
    monkeypatch.setattr(V, "BROADCAST_GROUPS", 0)
    assert V.silhouette(rows).first()[0] is not None
    with pytest.raises(ValueError):
        V.centroid_silhouette(rows)


def test_a_run_ends(spark):
    context = lambda p: X.context(p, "/r")
    files = spark.createDataFrame([("/r/Care/A/a.pdf", "A text of more than ten characters. And more.", None), ("/r/Care/A/form.pdf", " ", None), ("/r/b.pdf", None, "broken: yes")], "file_path string, text string, error string")
    state = spark.createDataFrame([(p, "pending", 0, None) for p in ("/r/Care/A/a.pdf", "/r/Care/A/form.pdf", "/r/b.pdf", "/r/gone.pdf")] + [("/r/old.pdf", "synced", 0, None)], "file_path string, sync_status string, sync_error_count int, last_error_message string")
    for batch in (None, 1):
        run = N.run_pipeline(state, files, context, M.HashingEmbedder(), batch=batch)
        got = {r.file_path: (r.sync_status, r.sync_error_count, r.last_error_message) for r in run.state.collect()}
        assert got == {"/r/Care/A/a.pdf": ("synced", 0, None), "/r/Care/A/form.pdf": ("synced", 0, None), "/r/b.pdf": ("error", 3, "broken: yes"), "/r/gone.pdf": ("error", 3, "File not found"), "/r/old.pdf": ("synced", 0, None)}
        assert run.operations.count() == 8 and run.chunks.count() == 2 == run.vectors.count()
    assert N.run_pipeline(state.limit(0), files, context, M.HashingEmbedder()).chunks.count() == 0


def test_embedding_batches(spark):
    rows = spark.createDataFrame([(i, "" if i == 5 else "one two three four") for i in range(10)], "doc_id long, text string")
    b = M.batches(rows.repartition(3), "doc_id", "text", 4, 0.5).first()
    assert (b.embeddings, b.tokens, b.batches, b.success_rate) == (10, 27, 3, pytest.approx(2 / 3))


def test_words_are_counted_as_one_by_one():
    e, texts = M.HashingEmbedder(8), ["a b a", "", None, "B b c c c é", "  "]
    want = np.zeros((5, 8))
    for i, t in enumerate(texts):
        for w in (t or "").lower().split():
            h = zlib.crc32(w.encode())
            want[i, h % 8] += 1 if h & 0x80000000 else -1
    n = np.linalg.norm(want, axis=1, keepdims=True)
    assert np.allclose(e.embed(texts), np.divide(want, n, out=np.zeros_like(want), where=n > 0))
    assert e.embed([]).shape == (0, 8)


def test_shared_folder_off_a_local_master(spark, monkeypatch):
    from corpusloom import session

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_paths_outside_the_root(spark):
    rows = spark.createDataFrame([("/x/a.pdf",)], "p string")
    assert rows.select(X.relative_path(F.col("p"), "/r")).first()[0] == "/x/a.pdf"
    with pytest.raises(Exception, match="not below"):
        rows.select(X.relative_path(F.col("p"), "/r", strict=True)).collect()


def test_scores_in_tiles(spark, monkeypatch):
    """However the queries and rows are cut, a worker holds a tile of scores, and equal vectors tie by key."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 5)).repeat(3, axis=0)
    x[::50] = 0
    frame = spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(rng.permutation(180), x)], "vec_id long, embedding array<double>")
    q = frame.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    want = []
    vectors = {r.vec_id: np.array(r.embedding) for r in frame.collect()}
    for k in sorted(v for v in vectors if v % 20 == 0):
        def score(a, b):
            n = float(np.linalg.norm(a) * np.linalg.norm(b))
            return round(float(a @ b) / n, 12) if n else 0.0
        want += [(k, i + 1, v) for i, v in enumerate(sorted(vectors, key=lambda v: (-score(vectors[k], vectors[v]), v))[:7])]
    for tile in (1024, 4):
        monkeypatch.setattr(W, "TILE", tile)
        assert sorted((r.query_id, r["rank"], r.vec_id) for r in W.batch_search(frame, q, 7).collect()) == want


def test_silhouette_copies_no_row(spark, monkeypatch):
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(40, 3)) + 1000, np.arange(40) % 3
    x[20:] = x[:20]
    y[20:] = y[:20]
    rows = spark.createDataFrame([(i, [float(v) for v in x[i]], int(y[i])) for i in range(40)], "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(W, "BLOCK_NUMBERS", 21)
    found = V.silhouette(rows, block_rows=7)
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    s = []
    for i in range(40):
        a = d[i][y == y[i]].sum() / ((y == y[i]).sum() - 1)
        b = min(d[i][y == k].mean() for k in set(y) - {y[i]})
        s.append((b - a) / max(a, b))
    assert found.first()[0] == pytest.approx(np.mean(s), abs=1e-9)
