"""Collections of vectors: Parquet folders with a catalogue, written version by version."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.operators import vectors as W

# What a collection is made with.
DEFAULTS = {"m": 16, "ef_construct": 100, "full_scan_threshold": 10_000, "segments": 2, "segment_size": 200_000, "indexing_threshold": 10_000}
DOCUMENT_DEFAULTS = DEFAULTS | {"segment_size": 100_000, "indexing_threshold": 5_000}


def collection_name(provider: str, prefix: str = "documents") -> str:
    return f"{prefix}_{provider}"


class Collections:
    """Collections below a folder that driver and executors share.

    A collection is a folder of versions and a small file that names the one in force. A change writes a new version and
    then that file, so readers see the old rows or the new ones, and a job that fails half-way changes nothing. The
    version before stays until the next change, for frames that were read from it. Names are those of folders: letters,
    digits, ``_`` and ``-``.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
        self._files = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ------------------------------------------------ the file that names the version in force

    def _head(self, name: str) -> str:
        if not name or not all(c.isalnum() or c in "_-" for c in name):
            raise ValueError(f"not a name: {name!r}")
        return f"{self.root}/{name}/head.json"

    def _read_head(self, name: str) -> dict | None:
        at = self._path(self._head(name))
        if not self._files.exists(at):
            return None
        stream = self._files.open(at)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _write_head(self, name: str, head: dict) -> None:
        fresh, at = self._path(f"{self._head(name)}.{uuid.uuid4().hex}"), self._path(self._head(name))
        stream = self._files.create(fresh)
        stream.write(json.dumps(head).encode())
        stream.close()
        self._files.delete(at, False)
        if not self._files.rename(fresh, at):
            raise OSError(f"could not commit {name}")

    # ------------------------------------------------ catalogue

    def create(self, name: str, dimension: int, metric: str = "cosine", options: dict | None = None) -> bool:
        """Whether it was made: a name that is taken stays as it is. An unknown metric is cosine."""
        if self.exists(name):
            return False
        metric = metric.lower() if metric.lower() in W.METRICS else "cosine"
        self._write_head(name, {"dimension": dimension, "metric": metric, "options": options or DEFAULTS, "version": None, "schema": None})
        return True

    def create_for(self, provider: str, dimension: int, metric: str = "cosine", prefix: str = "documents") -> bool:
        """A collection for a provider's vectors of documents, with smaller segments."""
        return self.create(collection_name(provider, prefix), dimension, metric, DOCUMENT_DEFAULTS)

    def exists(self, name: str) -> bool:
        return self._files.exists(self._path(self._head(name)))

    def info(self, name: str) -> dict | None:
        """Dimension, metric, options and number of vectors; None for an unknown name."""
        head = self._read_head(name)
        return None if head is None else {k: head[k] for k in ("dimension", "metric", "options")} | {"vectors": self.read(name).count()}

    def names(self) -> list[str]:
        root = self._path(self.root)
        found = self._files.listStatus(root) if self._files.exists(root) else []
        return sorted(n for n in (f.getPath().getName() for f in found) if self.exists(n))

    def listing(self) -> DataFrame:
        """One row for each collection: name, dimension, metric, vectors."""
        rows = [(n, i["dimension"], i["metric"], i["vectors"]) for n in self.names() if (i := self.info(n))]
        return self.spark.createDataFrame(rows, "name string, dimension int, metric string, vectors long")

    def delete(self, name: str) -> bool:
        return self.exists(name) and self._files.delete(self._path(f"{self.root}/{name}"), True)

    def cleanup(self, prefix: str) -> list[str]:
        """Delete the collections whose names do not begin with ``prefix``; the names that went."""
        return [n for n in self.names() if not n.startswith(prefix) and self.delete(n)]

    # ------------------------------------------------ rows

    def read(self, name: str) -> DataFrame:
        """``id``, ``vector`` and the payload's columns."""
        head = self._read_head(name)
        if head is None:
            raise ValueError(f"no collection {name!r}")
        if head["version"] is None:
            return self.spark.createDataFrame([], "id string, vector array<float>")
        return self.spark.read.schema(StructType.fromJson(head["schema"])).parquet(f"{self.root}/{name}/{head['version']}")

    def _commit(self, name: str, rows: DataFrame) -> None:
        head, version = self._read_head(name), f"v-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/{name}/{version}")
        self._write_head(name, head | {"version": version, "before": head["version"], "schema": json.loads(rows.schema.json())})
        if head.get("before"):
            self._files.delete(self._path(f"{self.root}/{name}/{head['before']}"), True)

    def _checked(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows whose vectors have the collection's length; any other ends the job."""
        n = self._read_head(name)["dimension"]
        wrong = F.raise_error(F.concat(F.lit(f"vectors of {name} have {n} numbers, not "), F.coalesce(F.size("vector").cast("string"), F.lit("none"))))
        return rows.withColumn("vector", F.when(F.size("vector") == n, F.col("vector")).otherwise(wrong.cast("array<float>")))

    def add(self, name: str, rows: DataFrame, vector: str = "vector", ident: str | None = None) -> DataFrame:
        """Add rows (a vector and payload columns); a known id takes the new row, payload and all. The ids, as ``id``.

        Without ``ident`` an id comes from the row's content, so the same row added again is the same point; of rows that
        name one id, one is kept. Columns that only one side has are null on the other.
        """
        if not self.exists(name):
            raise ValueError(f"no collection {name!r}")
        payload = [c for c in rows.columns if c not in (vector, ident)]
        key = F.col(ident).cast("string") if ident else F.sha2(F.to_json(F.struct(*[F.col(c) for c in rows.columns])), 256)
        fresh = rows.select(key.alias("id"), F.col(vector).cast("array<float>").alias("vector"), *payload)
        fresh = self._checked(name, fresh.groupBy("id").agg(F.max_by(F.struct(*fresh.columns[1:]), F.xxhash64(*fresh.columns[1:])).alias("r")).select("id", "r.*"))
        old = self.read(name)
        self._commit(name, old.join(fresh.select("id"), "id", "left_anti").unionByName(fresh, allowMissingColumns=True))
        return fresh.select("id")

    def update(self, name: str, changes: DataFrame) -> bool:
        """Rows by ``id``: with vectors and payload they replace rows; payload alone is merged, nulls change nothing.
        Vectors alone, and an unknown collection, are refused (False)."""
        payload = [c for c in changes.columns if c not in ("id", "vector")]
        if not payload or not self.exists(name):
            return False
        if "vector" in changes.columns:
            self.add(name, changes, ident="id")
        else:
            self._commit(name, W.merge_payload(self.read(name), changes, "id"))
        return True

    def remove(self, name: str, ids: DataFrame) -> bool:
        """Delete the points of ``ids`` (a column ``id``); unknown ones are passed over."""
        if not self.exists(name):
            return False
        self._commit(name, W.delete(self.read(name), ids, "id"))
        return True

    def search(self, name: str, query: Sequence[float], limit: int | None = 10, **how) -> DataFrame:
        """Search with the collection's metric."""
        return W.search(self.read(name), list(query), limit, self._read_head(name)["metric"], vector="vector", key="id", **how)


# Models by key: provider, model, dimension, price in dollars for 1000 tokens, batch size.
MODELS = {
    "dense_mpnet768": ("sentence_transformers", "all-mpnet-base-v2", 768, 0.0, 32),
    "dense_qa768": ("sentence_transformers", "multi-qa-mpnet-base-dot-v1", 768, 0.0, 32),
    "dense_mini384": ("sentence_transformers", "all-MiniLM-L6-v2", 384, 0.0, 64),
    "dense_openai1536": ("openai", "text-embedding-3-small", 1536, 0.00002, 100),
    "dense_openai3072": ("openai", "text-embedding-3-large", 3072, 0.00013, 100),
    "dense_cohere1024": ("cohere", "embed-english-v3.0", 1024, 0.0001, 96),
}


def models(spark: SparkSession, prefix: str = "documents") -> DataFrame:
    """The models, each with the name of its collection."""
    rows = [(k, collection_name(k, prefix), *v) for k, v in MODELS.items()]
    return spark.createDataFrame(rows, "model_key string, collection string, provider string, model_name string, dimension int, cost_per_1k double, batch_size int")


def with_collections(known: DataFrame, listing: DataFrame) -> DataFrame:
    """Models beside their collections: ``vectors`` (0 where there is none) and ``exists``."""
    found = listing.select(F.col("name").alias("collection"), "vectors").withColumn("exists", F.lit(True))
    return known.join(found, "collection", "left").withColumns({"vectors": F.coalesce("vectors", F.lit(0)), "exists": F.coalesce("exists", F.lit(False))})


def create_model(collections: Collections, model_key: str, force: bool = False, prefix: str = "documents") -> bool:
    """The collection of a model; with ``force`` one that is there is made anew. An unknown model gives False."""
    if model_key not in MODELS:
        return False
    name = collection_name(model_key, prefix)
    if force:
        collections.delete(name)
    return collections.create(name, MODELS[model_key][2])


def model_of(name: str, prefix: str = "documents") -> str | None:
    """The key of the model that a collection is for."""
    key = name.removeprefix(f"{prefix}_")
    return key if key in MODELS and name == collection_name(key, prefix) else None
