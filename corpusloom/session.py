"""Session helpers shared by every module: table access, shared folders, tables of intermediate steps."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables below ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def local_session(cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster the caller brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("corpusloom")
    defaults = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
    }
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset and the master is local, a temporary folder is made once and set. Off a local master that would
    be a folder of one machine, which the others don't see, so the caller has to name a shared one.
    """
    found = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
        found = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.deleteOnExit(target)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts lineage, survives lost executors."""
    return Scratch(df.sparkSession).table(df, label)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that no later step reads."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Intermediate tables of an operator, dropped one by one as soon as no later step reads them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, str] = {}
        self.names: dict[int, str] = {}
        self.kept: list[DataFrame] = []  # so that no other frame gets an id that is in use

    def table(self, df: DataFrame, label: str) -> DataFrame:
        """``df`` written to the shared folder and read back."""
        path = scratch_path(self.spark, label)
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        self.kept.append(out)
        return out

    def bucketed(self, df: DataFrame, label: str, *keys: str, dealt: bool = False) -> DataFrame:
        """``df`` written in as many buckets of ``keys`` as shuffles have partitions: joins and groups by those keys
        read it as it lies, without dealing its rows out again. Rows that are ``dealt`` by other columns stay where they
        are until they are written."""
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        path, name = scratch_path(self.spark, label), f"corpusloom_{label.replace('-', '_')}_{uuid.uuid4().hex}"
        rows = df if dealt else df.repartition(buckets, *keys)
        rows.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(buckets, *keys).saveAsTable(name)
        out = self.spark.table(name)
        self.paths[id(out)], self.names[id(out)] = path, name
        self.kept.append(out)
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables, and let Spark remove the shuffle files of steps whose results are written."""
        for t in tables:
            if name := self.names.pop(id(t), None):
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            if path := self.paths.pop(id(t), None):
                drop_path(self.spark, path)
        self.kept = [t for t in self.kept if id(t) in self.paths]
        release(self.spark)


def release(spark: SparkSession) -> None:
    """Spark removes shuffle files once the driver has no use for them, which it learns when garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
