"""Sharding along a Hilbert curve over several metadata dimensions, with DataFrame functions alone.

The dimensions are quantised to a few bits each, a curve index is computed from them, documents are ordered by that
index and the order is cut into runs. A shard then covers a compact region in every dimension, so readers that filter
on any of them skip most files. Global positions come from counts by cell and prefix sums over cells, so no task sees
the whole order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.common import let
from corpusloom.session import Scratch

#: Rows of a cell that a task ranks, about: a cell has as many buckets by hash as all rows make of these.
BUCKET_ROWS = 50_000


def hilbert_index(dims: Sequence[Column], bits: int) -> Column:
    """The Hilbert curve index of integer coordinates of ``bits`` bits each.

    The coordinates are turned into the curve's transposed form (undoing rotations from the highest bit down, then a
    Gray code) and their bits are interleaved.
    """
    n = len(dims)
    steps = [F.struct(F.lit(1 << b).cast("long").alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, 0, -1) for i in range(n)]

    def turn(x: Column, s: Column) -> Column:
        q, i = s["q"], s["i"]
        low, first, own = q - 1, F.get(x, F.lit(0)), F.get(x, i)
        invert = own.bitwiseAND(q) != 0
        swap = first.bitwiseXOR(own).bitwiseAND(low)

        def one(v: Column, j: Column) -> Column:
            flipped = F.when(j == 0, v.bitwiseXOR(low)).otherwise(v)
            swapped = F.when((j == 0) & (i != 0) | (j == i) & (i != 0), v.bitwiseXOR(swap)).otherwise(v)
            return F.when(invert, flipped).otherwise(swapped)

        return F.transform(x, one)

    x = F.array(*[d.cast("long") for d in dims])
    if steps:
        x = F.aggregate(F.array(*steps), x, turn)
    qs = F.array(*[F.lit(1 << b).cast("long") for b in range(bits - 1, 0, -1)]) if bits > 1 else F.array().cast("array<bigint>")
    zero = F.lit(0).cast("long")

    def gray(x: Column) -> Column:
        return F.transform(x, lambda _, j: F.aggregate(F.slice(x, F.lit(1), j + 1), zero, lambda a, v: a.bitwiseXOR(v)))

    def untwisted(g: Column) -> Column:
        last = F.element_at(g, -1)
        mask = F.aggregate(qs, zero, lambda t, q: F.when(last.bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t))
        return let(mask, lambda m: F.transform(g, lambda v: v.bitwiseXOR(m)))

    def interleaved(y: Column) -> Column:
        spots = [F.struct(F.lit(1 << b).cast("long").alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)]
        return F.aggregate(F.array(*spots), zero, lambda a, s: a * 2 + (F.get(y, s["i"]).bitwiseAND(s["q"]) != 0).cast("long"))

    return let(let(let(x, gray), untwisted), interleaved)


def _prefix(text: Column) -> Column:
    """A string's first six bytes as a number that keeps the order; null and empty are 0."""
    return F.coalesce(F.conv(F.rpad(F.hex(F.substring(F.encode(text, "utf-8"), 1, 6)), 12, "0"), 16, 10).cast("long"), F.lit(0))


def hilbert_shards(
    documents: DataFrame,
    shards: int = 16,
    bits: int = 5,
    text: str = "text",
    key: str = "doc_id",
    labels: Sequence[str] = ("lang", "source"),
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Each input row, as struct ``row`` (of the columns ``carry``, or all), with ``size``, ``text_crc32``, ``cell``,
    ``shard`` and ``slot``.

    Law: rows. Shards are runs of the curve order whose counts differ by one at most; ``slot`` counts from 0 in each.
    Dimensions: every column of ``labels`` (by its first bytes), the key (a number), and the size on a logarithmic scale.
    Groups: rows of equal text take the place of their row of least key (null last) and follow each other, so only a cut
    between two shards parts them. Rows of equal cell are ordered by a hash of the text, then by one of key and text; rows equal in
    all of that are interchangeable.

    Null labels and a null key take coordinate 0; a key that is no number ends the job. A null text has size 1 and
    checksum 0, and groups with empty ones. A very long text is measured, not moved, unless it is carried. Repeated rows
    are rows of their own. An empty table gives an empty result. The driver holds one row: the bounds of the
    dimensions and the number of rows.
    """
    top = (1 << bits) - 1
    scratch = Scratch(documents.sparkSession)
    own = lambda c: F.col(f"`{c}`")
    names = [f"d{i}" for i in range(len(labels) + 2)]
    size = F.coalesce(F.octet_length(own(text)), F.lit(0)).cast("long") + 1
    dims = [*[_prefix(own(c)) for c in labels], F.coalesce(own(key).cast("long"), F.lit(0)), size]
    plain = F.coalesce(own(text), F.lit(""))
    thin = documents.select(
        F.struct(*[own(c) for c in (documents.columns if carry is None else carry)]).alias("row"),
        size.alias("size"),
        F.coalesce(F.crc32(F.encode(own(text), "utf-8")), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64(plain).alias("ta"),
        F.xxhash64(F.lit(7), plain).alias("tb"),
        F.xxhash64(own(key), own(text)).alias("draw"),
        own(key).cast("long").alias("key"),
        *[c.alias(n) for c, n in zip(dims, names, strict=True)],
    )
    bounds = documents.select(*[c.alias(n) for c, n in zip(dims, names, strict=True)]).agg(F.count("*").alias("n"), *[f(c).alias(f"{c}_{f.__name__}") for c in names for f in (F.min, F.max)]).first()
    n = bounds["n"]
    # a table of its own, so that Spark can split a text that very many rows share in the join
    first = F.min(F.struct(F.col("key").isNull().alias("none"), "key", *names)).alias("first")
    groups = scratch.table(thin.groupBy("ta", "tb").agg(first, F.count("*").alias("copies")).where("copies > 1"), "groups")
    placed = thin.join(groups, ["ta", "tb"], "left").withColumn("copies", F.coalesce("copies", F.lit(1)))
    placed = placed.withColumns({c: F.coalesce(F.col("first")[c], F.col(c)) for c in names})

    def scaled(name: str) -> Column:
        low, high = bounds[f"{name}_min"] or 0, bounds[f"{name}_max"] or 0
        return F.floor((F.col(name).cast("double") - low) * (float(top + 1) / (high - low + 1.0))).cast("int")

    places = [F.least(F.lit(top), F.greatest(F.lit(0), scaled(c))) for c in names[:-1]]
    places.append(F.least(F.lit(top), F.floor(F.log2(F.col(names[-1]).cast("double")) * ((top + 1) / 32.0)).cast("int")))
    spread = max(1, -(-n // BUCKET_ROWS))
    large = F.col("copies") > BUCKET_ROWS
    placed = placed.withColumns({
        "cell": hilbert_index(places, bits),
        "salt": F.pmod("ta", F.lit(spread)),  # buckets inside a cell, so that a cell with a third of all rows is no single task's work
        "own": F.when(large, F.col("ta")),  # and buckets of its own for a text that fills several
        "part": F.when(large, F.pmod("draw", F.ceil(F.col("copies") / BUCKET_ROWS))).otherwise(0),
    }).drop(*names, "first", "key")
    bucket = ["cell", "salt", "own", "part"]
    fine = placed.groupBy(*bucket).agg(F.count("*").alias("n"))
    fine = fine.withColumn("coarse", F.shiftright("cell", max(0, bits * len(places) - 10)))
    above = fine.groupBy("coarse").agg(F.sum("n").alias("n"))  # 1024 rows at most
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    above = above.select("coarse", before(Window.orderBy("coarse")).alias("base"))
    starts = fine.withColumn("within", before(Window.partitionBy("coarse").orderBy(*bucket))).join(F.broadcast(above), "coarse")
    starts = starts.select(*[F.col(c).alias(f"s_{c}") for c in bucket], (F.col("base") + F.col("within")).alias("first"))
    ranked = placed.withColumn("rank", F.row_number().over(Window.partitionBy(*bucket).orderBy("ta", "tb", "draw", "text_crc32")))
    same = F.col("own").eqNullSafe(F.col("s_own"))
    for c in ("cell", "salt", "part"):
        same = same & (F.col(c) == F.col(f"s_{c}"))
    ordered = ranked.join(starts, same).withColumn("pos", F.col("first") + F.col("rank") - 1)
    # shard s holds positions ceil(s * n / shards) to ceil((s + 1) * n / shards) - 1
    shard = F.expr(f"pos * {shards}L div {max(n, 1)}L").cast("int")
    ordered = ordered.withColumn("shard", shard)
    start = F.expr(f"(shard * {max(n, 1)}L + {shards - 1}L) div {shards}L")
    return ordered.select("row", "size", "text_crc32", "cell", "shard", (F.col("pos") - start).alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """The rows as Parquet, one folder for each shard, in the order of their slots."""
    rows = sharded.select("shard", "slot", "row.*")
    rows.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
