"""Token-ID output: flat unsigned integer files plus 64-bit document offsets.

A partition of the documents, in ascending key order, becomes one set of files:

* ``<name>.bin``: the ids of its documents, one after another, little-endian unsigned 16-bit integers where the
  vocabulary allows it and 32-bit ones otherwise;
* ``<name>.off``: n + 1 little-endian signed 64-bit offsets into it, counted in ids;
* ``<name>.key``: n little-endian signed 64-bit keys, and ``<name>.nul``: n bytes, 1 where the key is null.

A manifest (Parquet) names the files of every committed partition; the prefix sums over its counts give each
partition's base. Files have names of their own for each attempt, so a task that is run again after an executor is
lost leaves at most unused files, never mixed ones.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import Batches, cached, small_batches, steady
from corpusloom.session import scratch_path, written

#: Bytes of input for a file.
FILE_BYTES = 128 << 20
#: Distinct words whose ids a worker keeps.
CACHE_WORDS = 200_000
#: A special token of the vocabulary, put between words that are encoded together.
SEPARATOR = "<|endoftext|>"
#: Longer words are encoded each time.
CACHE_LENGTH = 64


class WordEncoder:
    """Encodes texts by words, with the ids of words seen before kept in flat arrays.

    The tokenizer must not join text across spaces and newlines, which holds where white space is dropped and words
    are split by a pattern that matches no white space; ``encode`` then equals the tokenizer's own call.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end, self.separator = end_id, self.tokenizer.token_to_id(SEPARATOR)
        self.words = pa.array([""], pa.large_string())
        self.pool = np.zeros(0, dtype=np.uint32)  # the ids of all words, one word after another
        self.start, self.length, self.hits = (np.zeros(1, dtype=np.int64) for _ in range(3))

    def _tokenized(self, plain: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of strings one after another, and the number of each. Many are one text for the tokenizer, with a
        special token between them."""
        odd = [i for i, w in enumerate(plain) if SEPARATOR in w]
        own = {i: np.array(self.tokenizer.encode(plain[i], add_special_tokens=False).ids, dtype=np.uint32) for i in odd}
        rest = [w for w in plain if SEPARATOR not in w] if odd else plain
        texts = [SEPARATOR.join(rest[i : i + 512]) + SEPARATOR for i in range(0, len(rest), 512)]
        ids = [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.concatenate([*ids, np.zeros(0, np.uint32)])
        stops = np.flatnonzero(flat == self.separator)
        if len(stops) != len(rest):
            raise ValueError("the separator is no special token of the vocabulary")
        flat, lengths = flat[flat != self.separator], np.diff(stops, prepend=-1) - 1
        if not odd:
            return flat, lengths
        parts = iter(np.split(flat, np.cumsum(lengths)[:-1]) if len(rest) else [])
        every = [own[i] if i in own else next(parts) for i in range(len(plain))]
        return np.concatenate(every), np.array([len(x) for x in every], dtype=np.int64)

    def _learn(self, unknown: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of new words: each is a stem and the punctuation after it, which the tokenizer splits too, and many
        stems are words that are known."""
        halves = [part for w in unknown for part in _halves(w)]
        coded = pa.array(halves, pa.large_string()).dictionary_encode()
        known = pc.index_in(coded.dictionary, value_set=self.words)
        flat, lengths = self._tokenized(coded.dictionary.filter(pc.is_null(known)).to_pylist())
        pool, starts = np.concatenate([self.pool, flat]), np.cumsum(lengths) - lengths + len(self.pool)
        at = np.asarray(known.fill_null(0)).astype(np.int64)
        start, length = self.start[at], self.length[at]
        new = np.asarray(pc.is_null(known))
        start[new], length[new] = starts, lengths
        order = np.asarray(coded.indices)
        ids = _gather(pool, start[order], length[order])
        own = length[order]
        return ids, own[::2] + own[1::2]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the end id after it, and the number of ids of each."""
        lists = pc.split_pattern(pc.replace_substring(texts.cast(pa.large_string()).fill_null(""), "\n", " "), " ")
        coded = lists.flatten().dictionary_encode()  # each distinct word is looked up once a batch
        found = pc.index_in(coded.dictionary, value_set=self.words)
        at = np.asarray(found.fill_null(0)).astype(np.int64)
        missing = np.asarray(pc.is_null(found))
        self.hits[at[~missing]] += 1
        unknown = coded.dictionary.filter(pc.is_null(found))
        start, length, pool = self.start[at], self.length[at], self.pool
        if len(unknown):
            ids, own = self._learn(unknown.to_pylist())
            starts = np.cumsum(own) - own + len(pool)
            start[missing], length[missing], pool = starts, own, np.concatenate([pool, ids])
            short = pc.less_equal(pc.utf8_length(unknown), CACHE_LENGTH)
            keep = np.asarray(short)
            self.words = pa.concat_arrays([self.words, unknown.filter(short)])
            self.start, self.length = np.concatenate([self.start, starts[keep]]), np.concatenate([self.length, own[keep]])
            self.hits = np.concatenate([self.hits, np.ones(int(keep.sum()), np.int64)])
            self.pool = pool
        counts = np.diff(np.asarray(lists.offsets)) + 1
        ends = np.cumsum(counts) - 1
        inner = np.ones(int(counts.sum()), dtype=bool)
        inner[ends] = False
        order = np.full(len(inner), len(start), dtype=np.int64)  # the end id is one entry more
        order[inner] = np.asarray(coded.indices)
        start, length, pool = np.append(start, len(pool)), np.append(length, 1), np.append(pool, np.uint32(self.end))
        ids, lengths = _gather(pool, start[order], length[order]), length[order]
        if len(self.words) > CACHE_WORDS:
            self._forget()
        return ids, np.diff(np.cumsum(lengths)[ends], prepend=0)

    def _forget(self) -> None:
        """Keep the half of the words that most batches have had, the empty one among them."""
        self.hits[0] = np.iinfo(np.int64).max
        keep = np.sort(np.argsort(-self.hits, kind="stable")[: CACHE_WORDS // 2])
        self.words = self.words.take(pa.array(keep))
        self.pool = _gather(self.pool, self.start[keep], self.length[keep])
        self.length = self.length[keep]
        self.start, self.hits = np.cumsum(self.length) - self.length, self.hits[keep] // 2


def _gather(pool: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The ids of entries one after another."""
    after = np.cumsum(length)
    return pool[np.repeat(start - (after - length), length) + np.arange(after[-1] if len(after) else 0)]


class PlainEncoder:
    """Encodes whole texts with the tokenizer's own call: for any tokenizer."""

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.end = Tokenizer.from_file(path), end_id

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode_batch_fast([t or "" for t in texts.to_pylist()], add_special_tokens=False)
        ids = [np.array([*e.ids, self.end], dtype=np.uint32) for e in found]
        return np.concatenate([np.zeros(0, np.uint32), *ids]), np.array([len(x) for x in ids], dtype=np.int64)


# How the tokenizers normalise and split that may be given a text word by word. White space is dropped,
# case is lowered, and no piece crosses white space or goes from letters to punctuation.
WORD_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
WORD_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def splits_at_words(path: str) -> bool:
    """Whether a tokenizer's file says that its pieces are those of its words alone."""
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    pieces = (d.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    split = pieces[0].get("type") == "Split" and pieces[0].get("pattern") == {"Regex": WORD_PIECES} and pieces[0].get("behavior") == "Removed" and pieces[0].get("invert") is True
    inside = all(p.get("type") == "ByteLevel" and not p.get("add_prefix_space") and not p.get("use_regex") for p in pieces[1:])
    plain = not any(d.get(k) for k in ("truncation", "padding")) and d["model"].get("type") == "BPE" and not d["model"].get("dropout")
    separator = any(t["content"] == SEPARATOR and t["special"] and not t["lstrip"] and not t["rstrip"] for t in d.get("added_tokens", []))
    return (d.get("normalizer") or {}).get("normalizers") == WORD_NORMALIZERS and split and inside and plain and separator


def _halves(word: str) -> tuple[str, str]:
    """A Latin word in lower case and the punctuation that ends it; any other word whole, and nothing."""
    stem = word.rstrip(".,;:!?")
    if stem.isalpha() and max(stem) < "\u0130":
        return stem.lower(), word[len(stem) :]
    return word, ""


def encoder_for(path: str, end_id: int) -> WordEncoder | PlainEncoder:
    """One encoder for each worker process: its words stay known from task to task."""
    return cached("encoder", (path, end_id), lambda: (WordEncoder if splits_at_words(path) else PlainEncoder)(path, end_id))


def vocabulary_size(path: str) -> int:
    """The ids that a tokenizer can give, its added tokens included."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return max(tokenizer.get_vocab(with_added_tokens=True).values(), default=0) + 1


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def write_ids(documents: DataFrame, tokenizer: str, end_id: int = 2, text: str = "text", key: str = "doc_id", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Encode every whole text, write the files, and return the manifest with each partition's bases.

    Columns: ``part``, ``path`` (without suffix), ``n_docs``, ``n_tokens``, ``doc_base``, ``token_base``, ``wide``
    (32-bit ids). Documents go in ascending key order, null keys first; rows with equal keys are ordered by a hash
    of their text, and equal rows follow each other. A null text is encoded as an empty one, a very long text whole.
    Further columns of any name are left out. An empty table gives an empty manifest.

    Ids are 32 bits wide if the tokenizer or the end id needs it; an id that would not fit ends the job. There are as
    many files as shuffles have partitions, or more, so that a file comes from about ``file_bytes`` of input.
    """
    spark = documents.sparkSession
    small_batches(spark)
    folder = scratch_path(spark, "ids")
    wide = max(vocabulary_size(tokenizer), end_id + 1) > 1 << 16
    size = documents._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(1_000_000, -(-int(str(size)) // file_bytes)))
    thin = documents.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    thin = thin.withColumn("tie", F.xxhash64("text"))
    dealt = thin.repartitionByRange(parts, "key", "tie").sortWithinPartitions("key", "tie")

    @steady(keeps=("encoder",))
    def write(batches: Batches) -> Batches:
        encoder = encoder_for(tokenizer, end_id)
        part = TaskContext.get().partitionId()
        name = f"{folder}/{part:06d}-{uuid.uuid4().hex}"
        files, path = _open(name)
        files.create_dir(os.path.dirname(path), recursive=True)
        keys, nulls, counts = [], [], [np.zeros(1, dtype=np.int64)]
        with files.open_output_stream(path + ".bin") as out:
            for batch in batches:
                ids, n = encoder.encode(batch.column("text"))
                if not wide and len(ids) and int(ids.max()) >= 1 << 16:
                    raise ValueError(f"id {ids.max()} of a vocabulary of 16 bits")
                out.write(ids.astype("<u4" if wide else "<u2").tobytes())
                counts.append(n)
                k = batch.column("key")
                nulls.append(np.asarray(k.is_null()).astype(np.uint8))
                keys.append(np.asarray(k.fill_null(0)).astype("<i8"))
        offsets = np.cumsum(np.concatenate(counts))
        if len(offsets) == 1:
            return
        for suffix, data in ((".off", offsets.astype("<i8")), (".key", np.concatenate(keys)), (".nul", np.concatenate(nulls))):
            with files.open_output_stream(path + suffix) as out:
                out.write(data.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([name]), pa.array([len(offsets) - 1]), pa.array([int(offsets[-1])])], names=["part", "path", "n_docs", "n_tokens"])

    manifest = written(dealt.mapInArrow(write, "part int, path string, n_docs long, n_tokens long"), "ids-manifest")
    rows, docs, tokens, found = [], 0, 0, manifest.orderBy("part").collect()  # one row for each file
    for r in found:
        rows.append((r["part"], r["path"], r["n_docs"], r["n_tokens"], docs, tokens, wide))
        docs, tokens = docs + r["n_docs"], tokens + r["n_tokens"]
    return spark.createDataFrame(rows, "part int, path string, n_docs long, n_tokens long, doc_base long, token_base long, wide boolean")


def _mapped(path: str, dtype: str):
    """A file's numbers: memory-mapped where the store is a file system, else read in ranges."""
    files, inner = _open(path)
    if isinstance(files, pafs.LocalFileSystem):
        return np.memmap(inner, dtype=dtype, mode="r") if os.path.getsize(inner) else np.zeros(0, dtype)
    source, width = files.open_input_file(inner), np.dtype(dtype).itemsize

    class Ranges:
        def __getitem__(self, s: slice) -> np.ndarray:
            stop = s.stop if s.stop is not None else source.size() // width
            begin = s.start or 0
            return np.frombuffer(source.read_at((stop - begin) * width, begin * width), dtype=dtype)

    return Ranges()


def read_ids(manifest: DataFrame, block: int = 4096) -> DataFrame:
    """Every document read back from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    ``start`` counts the ids of all documents before it; ``ids_crc32`` is the unsigned CRC-32 of the document's ids
    as little-endian unsigned 32-bit integers.
    """

    def read(batches: Batches) -> Batches:
        for batch in batches:
            for r in batch.to_pylist():
                ids = _mapped(r["path"] + ".bin", "<u4" if r["wide"] else "<u2")
                offsets, keys, nulls = (_mapped(r["path"] + s, t) for s, t in ((".off", "<i8"), (".key", "<i8"), (".nul", "u1")))
                for a in range(0, r["n_docs"], block):
                    b = min(a + block, r["n_docs"])
                    off = np.array(offsets[a : b + 1])
                    data = ids[int(off[0]) : int(off[-1])]
                    at = off - off[0]
                    crc = [zlib.crc32(data[i:j].astype("<u4").tobytes()) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.array(keys[a:b]), pa.int64(), mask=np.array(nulls[a:b]).astype(bool)),
                            pa.array(off[:-1] + r["token_base"], pa.int64()),
                            pa.array(np.diff(off), pa.int64()),
                            pa.array(crc, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    parts = max(1, manifest.count())
    return manifest.repartition(parts).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_ids(documents: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write every document's ids, read the files back, one row per document (see ``write_ids``, ``read_ids``)."""
    return read_ids(write_ids(documents, tokenizer, end_id))
