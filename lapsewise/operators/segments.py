"""Unsupervised risk segments."""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.common import _py2java
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from lapsewise.fixed_values import SEED, SEGMENT_NAMES
from lapsewise.operators.partial_sums import summed
from lapsewise.schemas import BEHAVIOUR_FEATURES

_RAW, _SCALED = "_behaviour", "_behaviour_scaled"
#: Rows from which the first centres are drawn, whatever the size of the table.
SEEDING_ROWS = 10_000
#: A start has settled when no centre moves further than this.
SETTLED = 1e-4
#: A pass has a task for so many rows, or one a core if that is more: the driver keeps account of every task.
ROWS_PER_TASK = 100_000


def drawn_rows(vectors: DataFrame, n_rows: int, wanted: int = SEEDING_ROWS) -> np.ndarray:
    """Of rows (z, hash) the ``wanted`` of the smallest hashes, as a matrix.

    A bound on the hash that leaves a few times as many is found by counting, so tasks pass on few
    rows; those are put in order by an executor, so the driver gets the wanted ones only.
    """
    bounds, share = [], 2 * wanted / n_rows
    while share < 1:
        bounds.append(int(share * 2**64) - 2**63)
        share *= 4
    if bounds:
        below = vectors.agg(*[F.count(F.when(F.col("hash") < bound, 1)) for bound in bounds]).head()
        # equal rows have equal hashes, so the first bound may leave too few
        enough = [bound for bound, n in zip(bounds, below) if n >= wanted]
        vectors = vectors.where(F.col("hash") < enough[0]) if enough else vectors
    # collect() would send this many rows of every task to the driver and merge them there
    drawn = vectors.orderBy("hash", "z").limit(wanted).select("z").toArrow()
    return np.array(drawn["z"].to_pylist())


def first_centres(sample: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """``k`` rows of the sample, each drawn with the square of its distance to those before it."""
    chosen = [sample[rng.integers(len(sample))]]
    for _ in range(k - 1):
        away = np.min([((sample - c) ** 2).sum(axis=1) for c in chosen], axis=0)
        total = away.sum()
        chosen.append(sample[rng.choice(len(sample), p=away / total) if total > 0 else rng.integers(len(sample))])
    return np.array(chosen)


def move_centres(vectors: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One step of Lloyd's iteration for several sets of centres (sets, k, columns) in one pass.

    Returns the moved centres and each set's cost before the move. A centre without rows stays."""
    sets, k, width = centres.shape

    def of_batch(rows: np.ndarray) -> np.ndarray:
        sums, counts, costs = np.zeros((sets, k, width)), np.zeros((sets, k)), np.zeros(sets)
        for i in range(sets):
            apart = ((rows[:, None, :] - centres[i][None, :, :]) ** 2).sum(axis=2)
            nearest = apart.argmin(axis=1)
            costs[i] = apart[np.arange(len(rows)), nearest].sum()
            member = nearest[:, None] == np.arange(k)
            counts[i] = member.sum(axis=0)
            sums[i] = member.T.astype(np.float64) @ rows
        return np.concatenate([sums.ravel(), counts.ravel(), costs])

    found = summed(vectors, of_batch, sets * k * (width + 1) + sets)
    sums, counts, costs = np.split(found, [sets * k * width, sets * k * (width + 1)])
    sums, counts = sums.reshape(sets, k, width), counts.reshape(sets, k)
    moved = np.where(counts[:, :, None] > 0, sums / np.maximum(counts, 1)[:, :, None], centres)
    return moved, costs


def best_centres(vectors: DataFrame, sample: np.ndarray, k: int, seed: int, starts: int, most_steps: int) -> np.ndarray:
    """The centres of the cheapest of ``starts`` starts; all that still move take each step together."""
    centres = np.stack([first_centres(sample, k, np.random.default_rng([seed, start])) for start in range(starts)])
    moving, costs = np.arange(starts), np.full(starts, np.inf)
    for _ in range(most_steps):
        moved, costs[moving] = move_centres(vectors, centres[moving])
        far = np.sqrt(((moved - centres[moving]) ** 2).sum(axis=2)).max(axis=1)
        centres[moving] = moved
        moving = moving[far > SETTLED]
        if not len(moving):
            break
    return centres[costs.argmin()]


def _kmeans_model(table: DataFrame, centres: np.ndarray) -> KMeansModel:
    jvm, context = table.sparkSession._jvm, table.sparkSession.sparkContext
    found = jvm.java.util.ArrayList()
    for centre in centres:
        found.add(jvm.org.apache.spark.mllib.linalg.Vectors.fromML(_py2java(context, Vectors.dense(centre.tolist()))))
    model = KMeansModel(jvm.org.apache.spark.ml.clustering.KMeansModel("segments", jvm.org.apache.spark.mllib.clustering.KMeansModel(found)))
    return model.setFeaturesCol(_SCALED).setPredictionCol("cluster")


def fit_segments(
    table: DataFrame, k: int = 3, seed: int = SEED, starts: int = 10, most_steps: int = 300
) -> PipelineModel:
    """K-means on the standardised behaviour columns, best of ``starts`` seeds.

    Label and status are never used. ``table`` should be stored. All starts move
    in the same passes, and what a pass returns does not grow with the table.
    """
    assembler = VectorAssembler(inputCols=BEHAVIOUR_FEATURES, outputCol=_RAW, handleInvalid="error")
    assembled = assembler.transform(table).select(_RAW)
    scaler = StandardScaler(inputCol=_RAW, outputCol=_SCALED, withMean=True).fit(assembled)
    n_rows = table.count()
    if n_rows < k:
        raise ValueError(f"{n_rows} policies cannot form {k} segments")
    tasks = max(table.sparkSession.sparkContext.defaultParallelism, -(-n_rows // ROWS_PER_TASK))
    # hashed before scaling, whose last digits follow the order of its sums: the same rows are drawn every time
    hashed = F.xxhash64(vector_to_array(_RAW)).alias("hash")
    scaled = scaler.transform(assembled).select(vector_to_array(_SCALED).alias("z"), hashed).coalesce(tasks)
    vectors = scaled.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        centres = best_centres(vectors.select("z"), drawn_rows(vectors, n_rows), k, seed, starts, most_steps)
    finally:
        vectors.unpersist()
    return PipelineModel([assembler, scaler, _kmeans_model(table, centres)])


def assign_segments(model: PipelineModel, table: DataFrame) -> DataFrame:
    """``table`` with its ``cluster``; ids are arbitrary."""
    return model.transform(table).drop(_RAW, _SCALED)


def cluster_severity(clustered: DataFrame) -> DataFrame:
    """Per cluster: mean failed ratio, its rank from mildest, and the segment name.

    The first three ranks are Low, Medium and High risk; further ones are numbered.
    """
    severity = (
        clustered.where(F.col("cluster").isNotNull())
        .groupBy("cluster")
        .agg(F.avg("failed_invoice_ratio").alias("severity"))
    )
    # one row per cluster by now
    rank = F.row_number().over(W.orderBy("severity", "cluster")) - 1
    named = F.get(F.array(*[F.lit(n) for n in SEGMENT_NAMES]), F.col("severity_rank"))
    return severity.withColumn("severity_rank", rank).withColumn(
        "segment_label",
        F.coalesce(named, F.concat(F.lit("Risk tier "), F.col("severity_rank").cast("string"))),
    )


def label_segments(clustered: DataFrame) -> DataFrame:
    """Add ``segment_label``. The names are one row per cluster, hence broadcast."""
    names = cluster_severity(clustered).select("cluster", "segment_label")
    return clustered.join(F.broadcast(names), "cluster", "left").select(
        *clustered.columns, "segment_label"
    )
