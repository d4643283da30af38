"""Retrieval and clustering quality."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.operators import vectors as W
from corpusloom.operators.vectors import dot, euclidean

#: Rows of a block of vectors, and rows that a task measures at once against eight times as many of a round.
BLOCK_ROWS, TILE = 2048, 256
#: Blocks up to which all distances are measured: their pairs are the square of this, and each row is copied as often.
MOST_BLOCKS = 512
#: Groups up to which their sums are broadcast.
BROADCAST_GROUPS = 10_000


def retrieval_metrics(ranked: DataFrame, expected: DataFrame, query_key: str = "query_id", precision_at: int = 5, recall_at: int = 10) -> DataFrame:
    """By query: ``precision``, ``recall``, ``reciprocal_rank`` from rows with ``rank`` and boolean ``hit``.

    Precision is over the rows that there are; queries without expected documents score 0. ``expected`` has the
    number ``n_expected`` by query.
    """
    top = lambda k: F.col("rank") <= k
    by = ranked.groupBy(query_key).agg(
        (F.count_if(F.col("hit") & top(precision_at)) / F.count_if(top(precision_at))).alias("precision"),
        F.count_if(F.col("hit") & top(recall_at)).alias("found"),
        F.coalesce(1.0 / F.min(F.when(F.col("hit"), F.col("rank"))), F.lit(0.0)).alias("reciprocal_rank"),
    )
    joined = expected.join(by, query_key, "left")
    some = F.col("n_expected") > 0
    return joined.select(
        query_key,
        F.when(some, F.coalesce("precision", F.lit(0.0))).otherwise(0.0).alias("precision"),
        F.when(some, F.coalesce("found", F.lit(0)) / F.col("n_expected")).otherwise(0.0).alias("recall"),
        F.when(some, F.coalesce("reciprocal_rank", F.lit(0.0))).otherwise(0.0).alias("reciprocal_rank"),
    )


def _unit_sums(vectors: DataFrame, vector: str, label: str) -> DataFrame:
    """By label: the number of rows and the sum of their unit vectors, dimension by dimension."""
    v = F.col(vector)
    unit = F.transform(v, lambda x: F.coalesce(F.try_divide(x.cast("double"), F.sqrt(dot(v, v))), F.lit(0.0)))
    dims = vectors.select(label, F.posexplode(unit).alias("d", "x")).groupBy(label, "d").agg(F.sum("x").alias("x"), F.count("*").alias("n"))
    return dims.groupBy(label).agg(F.transform(F.sort_array(F.collect_list(F.struct("d", "x"))), lambda s: s["x"]).alias("total"), F.max("n").alias("n"))


def intra_cluster(vectors: DataFrame, vector: str = "embedding", label: str = "label") -> DataFrame:
    """Mean cosine inside each group of two or more, and the mean over groups, from sums of unit vectors."""
    sums = _unit_sums(vectors, vector, label).where("n > 1")
    each = (dot(F.col("total"), F.col("total")) - F.col("n")) / (F.col("n") * (F.col("n") - 1))
    return sums.agg(F.coalesce(F.avg(each), F.lit(0.0)).alias("intra_similarity"), F.count("*").alias("groups"))


def inter_cluster(vectors: DataFrame, vector: str = "embedding", label: str = "label") -> DataFrame:
    """1 less the mean over pairs of groups of their mean cosine; 0 without a pair.

    No pair is made: with the mean unit vector of each group, the cosines of all pairs sum to half of the square of the
    sum of the means less the sum of their squares.
    """
    means = _unit_sums(vectors, vector, label).select(F.transform("total", lambda x: x / F.col("n")).alias("m"))
    squares = means.agg(F.count("*").alias("groups"), F.sum(dot(F.col("m"), F.col("m"))).alias("own"))
    total = means.select(F.posexplode("m").alias("d", "x")).groupBy("d").agg(F.sum("x").alias("x")).agg(F.sum(F.col("x") * F.col("x")).alias("all"))
    mean = (F.col("all") - F.col("own")) / (F.col("groups") * (F.col("groups") - 1))
    return squares.join(total).select(F.when(F.col("groups") > 1, 1.0 - mean).otherwise(0.0).alias("inter_separation"))


def silhouette(vectors: DataFrame, vector: str = "embedding", label: str = "label", key: str = "vec_id", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Mean silhouette with Euclidean distances; members of groups of one score 0, fewer than two groups give 0.

    Distances are between all rows by definition, so the work is the square of the rows. The driver reads blocks of rows
    in rounds of ``vectors.BLOCK_NUMBERS`` numbers; workers hold one round, measure tiles of their rows against it and send only sums
    by row and group, so no row is copied and the shuffle is a row for each row, group and round. More than ``MOST_BLOCKS`` blocks
    (about a million rows) are refused: ``centroid_silhouette`` is for those.
    """
    n = vectors.count()
    blocks = max(1, math.ceil(n / block_rows))
    if blocks > MOST_BLOCKS:
        raise ValueError(f"{n} rows are too many for all distances; use centroid_silhouette")
    first = vectors.select(F.size(vector)).first()
    held = max(1, W.BLOCK_NUMBERS // (block_rows * max(1, first[0] if first else 1)))
    placed = vectors.select(F.col(label).alias("l"), F.col(vector).alias("v"), F.pmod(F.xxhash64(key), F.lit(blocks)).alias("b"))
    kinds = {f: vectors.schema[f].dataType.simpleString() for f in (key, label)}
    parts = None
    for at in range(0, blocks, held):
        block = placed.where((F.col("b") >= at) & (F.col("b") < at + held)).select("l", "v").orderBy("l").toArrow().combine_chunks()
        labels, starts = np.unique(np.asarray(block.column("l")), return_index=True)
        y = np.concatenate([W.matrix(c) for c in block.column("v").chunks]) if block.num_rows else np.zeros((0, 1))
        shared = vectors.sparkSession.sparkContext.broadcast((labels, starts, y))

        def sums(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            labels, starts, y = shared.value
            yy = (y * y).sum(axis=1)
            for b in batches:
                rows = W.matrix(b.column(2)) if b.num_rows and len(y) else np.zeros((0, 1))
                for r in range(0, len(rows), TILE):
                    x = rows[r : r + TILE]
                    xx = (x * x).sum(axis=1)
                    total = np.zeros((len(x), len(labels)))
                    for c in range(0, len(y), 8 * TILE):
                        z = y[c : c + 8 * TILE]
                        scale = xx[:, None] + yy[None, c : c + 8 * TILE]
                        d = x @ z.T
                        d *= -2.0
                        d += scale
                        scale *= 1e-9
                        i, k = np.nonzero(d <= scale)  # too near for a difference of squares
                        for a in range(0, len(i), 16 * TILE):
                            p, q = i[a : a + 16 * TILE], k[a : a + 16 * TILE]
                            d[p, q] = ((x[p] - z[q]) ** 2).sum(axis=1)
                        np.sqrt(d, out=d)
                        low, high = np.searchsorted(starts, c, "right") - 1, np.searchsorted(starts, c + len(z))
                        total[:, low:high] += np.add.reduceat(d, np.maximum(starts[low:high] - c, 0), axis=1)
                    each, to = np.repeat(np.arange(r, r + len(x)), len(labels)), np.tile(np.arange(len(labels)), len(x))
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array(each)), b.column(1).take(pa.array(each)), pa.array(labels[to], b.schema.field(1).type), pa.array(total.reshape(-1))], names=["k", "own", "l", "total"]
                    )

        part = vectors.select(key, label, vector).mapInArrow(sums, f"k {kinds[key]}, own {kinds[label]}, l {kinds[label]}, total double")
        parts = part if parts is None else parts.union(part)
    sizes = vectors.groupBy(F.col(label).alias("l")).agg(F.count("*").alias("n"))
    few = F.broadcast(sizes) if sizes.count() <= BROADCAST_GROUPS else sizes
    by = parts.groupBy("k", "own", "l").agg(F.sum("total").alias("total")).join(few, "l")
    same = F.col("l") == F.col("own")
    score = by.groupBy("k").agg(
        F.max(F.when(same, F.when(F.col("n") > 1, F.col("total") / (F.col("n") - 1)))).alias("a"), F.min(F.when(~same, F.col("total") / F.col("n"))).alias("b")
    )
    one = F.when(F.col("a").isNull() | F.col("b").isNull(), 0.0).otherwise(F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return score.agg(F.coalesce(F.avg(one), F.lit(0.0)).alias("silhouette"))


def centroid_silhouette(vectors: DataFrame, vector: str = "embedding", label: str = "label") -> DataFrame:
    """Mean simplified silhouette: distances to the centroids of a row's own group and of the nearest other one; fewer
    than two groups give 0. Linear in the rows for a number of groups of up to ``BROADCAST_GROUPS``, beyond which it is refused.
    """
    dims = vectors.select(label, F.posexplode(vector).alias("d", "x")).groupBy(label, "d").agg(F.avg(F.col("x").cast("double")).alias("x"))
    centres = dims.groupBy(label).agg(F.transform(F.sort_array(F.collect_list(F.struct("d", "x"))), lambda s: s["x"]).alias("c"))
    if centres.count() > BROADCAST_GROUPS:
        raise ValueError(f"more than {BROADCAST_GROUPS} groups")
    every = centres.agg(F.collect_list(F.struct(F.col(label).alias("l"), F.col("c"))).alias("cs"))  # at most that many rows
    rows = vectors.select(F.col(label).alias("l"), F.col(vector).alias("v")).join(F.broadcast(every))
    far = lambda own: F.array_min(F.transform(F.filter("cs", lambda s: (s["l"] == F.col("l")) == F.lit(own)), lambda s: euclidean(F.col("v"), s["c"])))
    near = rows.select(far(True).alias("a"), far(False).alias("b"))
    one = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    return near.agg(F.coalesce(F.avg(F.when(F.col("a").isNull() | F.col("b").isNull(), 0.0).otherwise(one)), F.lit(0.0)).alias("silhouette"))


def quality_scores(precision: Column, recall: Column, rr: Column, sil: Column, intra: Column, inter: Column, cross_p: Column, cross_r: Column) -> Column:
    """Retrieval, semantic and overall quality from 0 to 1."""
    clamp = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))
    retrieval = clamp(0.4 * precision + 0.3 * recall + 0.3 * rr)
    semantic = clamp(0.4 * (sil + 1) / 2 + 0.3 * intra + 0.3 * inter)
    overall = clamp(0.5 * retrieval + 0.3 * semantic + 0.2 * (cross_p + cross_r) / 2)
    return F.struct(retrieval.alias("retrieval_quality"), semantic.alias("semantic_quality"), overall.alias("overall_quality"))


def cost(documents: Column, queries: Column, price: Column) -> Column:
    """Estimated tokens, total cost and cost by query: 200 words a document, 10 a query, 0.75 tokens a word."""
    tokens = (documents * 200 + queries * 10) * 0.75
    total = tokens / 1000.0 * price
    return F.struct(tokens.alias("tokens"), total.alias("total_cost"), F.coalesce(F.try_divide(total, queries), F.lit(0.0)).alias("cost_per_query"))


# Embeddings in a second by kind of provider, and milliseconds of a search.
SPEEDS = {"sentence_transformers": 100.0, "openai": 50.0, "cohere": 30.0}
OTHER_SPEED, SEARCH_MS = 50.0, 1.0


def performance(kind: Column) -> Column:
    """Assumed speed of a provider: milliseconds an embedding and a search, embeddings in a second."""
    speed = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in SPEEDS.items() for x in kv]), kind), F.lit(OTHER_SPEED))
    return F.struct((1000.0 / speed).alias("avg_embedding_time_ms"), F.lit(SEARCH_MS).alias("avg_search_time_ms"), speed.alias("embeddings_per_second"))


# Test queries: id, text, sections that should answer, difficulty; by type.
TEST_QUERIES = {
    "specific": [
        ("infection_control_01", "What are the hand hygiene requirements for staff?", ["IPC"], "easy"),
        ("medication_management_01", "How should controlled substances be stored and monitored?", ["CARE"], "medium"),
        ("emergency_procedures_01", "What is the fire evacuation procedure for residents with mobility issues?", ["EPM"], "medium"),
        ("privacy_confidentiality_01", "What information can be shared with family members without consent?", ["PRV"], "hard"),
        ("maintenance_safety_01", "How often should medical equipment be inspected and calibrated?", ["MAINT"], "medium"),
    ],
    "cross_reference": [
        ("cross_infection_care_01", "What infection control measures are required during personal care?", ["IPC", "CARE"], "medium"),
        ("cross_emergency_care_01", "How do emergency procedures change for residents on isolation precautions?", ["EPM", "IPC"], "hard"),
        ("cross_privacy_admin_01", "What documentation is required for privacy breach incidents?", ["PRV", "ADM"], "medium"),
    ],
    "procedural": [
        ("procedure_admission_01", "What steps are involved in the resident admission process?", ["ADM", "CARE"], "medium"),
        ("procedure_incident_01", "How should staff respond to a resident fall incident?", ["CARE", "ADM"], "medium"),
        ("procedure_discharge_01", "What documentation is required for resident discharge?", ["ADM", "PRV"], "medium"),
    ],
    "compliance": [
        ("compliance_training_01", "What training is required for new nursing staff?", ["ADM", "CARE"], "medium"),
        ("compliance_documentation_01", "How long must resident care records be retained?", ["ADM", "PRV"], "hard"),
        ("compliance_reporting_01", "What incidents must be reported to regulatory authorities?", ["ADM", "LEG"], "hard"),
    ],
    "safety": [
        ("safety_chemical_01", "How should cleaning chemicals be stored and labeled?", ["EVS", "MAINT"], "easy"),
        ("safety_lift_01", "What safety procedures apply when using mechanical lifts?", ["CARE", "MAINT"], "medium"),
        ("safety_outbreak_01", "What steps should be taken during an infectious disease outbreak?", ["IPC", "EPM"], "hard"),
    ],
}


def test_queries(spark: SparkSession) -> DataFrame:
    """The test queries as a table. Which documents they should find is not stated; ``expected_by_section`` finds those."""
    rows = [(i, t, kind, s, d) for kind, found in TEST_QUERIES.items() for i, t, s, d in found]
    return spark.createDataFrame(rows, "query_id string, text string, query_type string, expected_sections array<string>, difficulty string")


test_queries.__test__ = False


def expected_by_section(queries: DataFrame, documents: DataFrame, section: str = "policy_acronym", key: str = "doc_id") -> DataFrame:
    """``query_id`` and ``key`` of the documents in each query's sections."""
    wanted = queries.select("query_id", F.explode("expected_sections").alias(section)).distinct()
    return documents.select(key, section).join(F.broadcast(wanted), section).select("query_id", key)


def save_evaluation(models: DataFrame, evaluations: DataFrame, results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The models and evaluations with new results added.

    ``results`` has ``provider_name``, ``model_name``, ``dimension``, ``cost_per_1k`` and the measures, which are columns
    of ``evaluations`` too. A model is known by its provider, the name up to the first ``_``, and its model name; one that is not
    there is added with the next ids, in the order of those names.
    """
    named = results.withColumn("provider", F.substring_index("provider_name", "_", 1))
    keys = ["provider", "model_name"]
    missing = named.groupBy(*keys).agg(F.first("dimension").alias("dimension"), F.first("cost_per_1k").alias("cost_per_1k")).join(models.select(*keys), keys, "left_anti")
    top = models.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))
    fresh = missing.join(top).select((F.col("top") + F.row_number().over(Window.orderBy(*keys))).cast("long").alias("id"), *keys, "dimension", "cost_per_1k", F.lit(True).alias("is_active"))
    after = models.unionByName(fresh, allowMissingColumns=True)
    rows = named.join(after.select(F.col("id").alias("embedding_model_id"), *keys), keys)
    rows = rows.select(*[F.col(c) for c in evaluations.columns])
    return after, evaluations.unionByName(rows)
