"""Product segments: scaling, clustering, silhouette and 2-D coordinates."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from shelfwise import lexicon
from shelfwise.functions.numeric import coerce_double
from shelfwise.functions.ranking import scalar_struct
from shelfwise.operators.cleaning import impute_median, present, with_segment
from shelfwise.session import stage

#: Iterations of a clustering at most, and how far centres at rest may move: MLlib's own.
MAX_ITER, TOLERANCE = 100, 1e-4


def feature_columns(products: DataFrame, features: Sequence[str] = lexicon.SEGMENT_FEATURES) -> list[str]:
    found = present(products, features)
    if len(found) < 2:
        raise ValueError(f"need at least two feature columns of {list(features)}")
    return found


def with_features(
    products: DataFrame,
    features: Sequence[str] = lexicon.SEGMENT_FEATURES,
    fill: str = "median",
) -> DataFrame:
    """Numeric features without gaps: the median, or 0.

    Staged before it is filled, as medians and scaling read it several times.
    """
    columns = feature_columns(products, features)
    coerced = stage(products.withColumns({c: coerce_double(F.col(c)) for c in columns}), "features")
    if fill == "median":
        coerced = impute_median(coerced, columns)
    return coerced.na.fill(0.0, columns)


def standardize(df: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """Zero mean and unit population variance; constant columns become 0."""
    moments = scalar_struct(
        df.agg(
            *[F.avg(c).alias(f"{c}_mean") for c in columns],
            *[F.stddev_pop(c).alias(f"{c}_std") for c in columns],
        )
    )

    def scaled(c: str):
        mean, std = F.col("_moments")[f"{c}_mean"], F.col("_moments")[f"{c}_std"]
        return F.when(std == 0, 0.0).otherwise((F.col(c) - mean) / std)

    looked_up = df.withColumn("_moments", moments)
    return looked_up.withColumns({f"{c}{suffix}": scaled(c) for c in columns}).drop("_moments")


def with_vector(df: DataFrame, columns: Sequence[str], suffix: str = "_z") -> DataFrame:
    """The standardized columns as one ``scaled`` vector."""
    names = [f"{c}{suffix}" for c in columns]
    scaled = standardize(df, columns, suffix)
    return VectorAssembler(inputCols=names, outputCol="scaled").transform(scaled).drop(*names)


def _kmeans(k: int, seed: int, max_iter: int = MAX_ITER) -> KMeans:
    return KMeans(k=k, seed=seed, featuresCol="scaled", predictionCol="cluster_id", maxIter=max_iter, tol=TOLERANCE)


@dataclass(eq=False)
class Start:
    """A start's centres on their way, and the cost at the last assignment."""

    k: int
    seed: int
    centres: np.ndarray
    cost: float = float("inf")
    moving: bool = True

    def sums(self, x: np.ndarray, squares: np.ndarray) -> tuple[np.ndarray, float]:
        """Count and sums of each cluster's rows, and the cost of the rows."""
        away = (self.centres**2).sum(axis=1) - 2 * (x @ self.centres.T)
        nearest = away.argmin(axis=1)
        cost = np.maximum(away[np.arange(len(x)), nearest] + squares, 0.0).sum()
        parts = [np.bincount(nearest, w, len(self.centres)) for w in (None, *x.T)]
        return np.column_stack(parts), float(cost)

    def move(self, found: np.ndarray) -> None:
        held = found[:, 0] > 0
        moved = self.centres.copy()
        moved[held] = found[held, 1:] / found[held, :1]
        self.moving = bool((((moved - self.centres) ** 2).sum(axis=1) > TOLERANCE**2).any())
        self.centres = moved


def settle(vectors: DataFrame, starts: Sequence[Start], max_iter: int = MAX_ITER) -> None:
    """Lloyd's iterations of all starts in the same passes, each until its centres rest, as MLlib's run one by one.

    A task adds up its rows for every start; only sums per cluster leave it.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64()), pa.array([x.tobytes()], pa.binary())], ["n", "x"])

    blocks = stage(vectors.select(vector_to_array("scaled").alias("x")).mapInArrow(packed, "n long, x binary"), "points").persist()
    for _ in range(max_iter):
        live = [(i, s) for i, s in enumerate(starts) if s.moving]
        if not live:
            break

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, list] = {}
            for batch in batches:
                for n, x in zip(batch.column("n").to_pylist(), batch.column("x")):
                    rows = np.frombuffer(x.as_buffer(), np.float64).reshape(n, -1)
                    squares = (rows**2).sum(axis=1)
                    for i, s in live:
                        sums, cost = s.sums(rows, squares)
                        of = total.setdefault(i, [0.0, 0.0])
                        of[:] = of[0] + sums, of[1] + cost
            made = [(i, j, cost if j == 0 else 0.0, row.tolist()) for i, (sums, cost) in total.items() for j, row in enumerate(sums)]
            kinds = (pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.float64()))
            columns = zip(*made) if made else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["start", "cluster", "cost", "sums"])

        width = live[0][1].centres.shape[1] + 1
        of_tasks = blocks.mapInArrow(added, "start int, cluster int, cost double, sums array<double>")
        rows = of_tasks.groupBy("start", "cluster").agg(F.sum("cost").alias("cost"), F.array(*[F.sum(F.col("sums")[c]) for c in range(width)]).alias("sums")).collect()
        for i, s in live:
            own = sorted((r for r in rows if r.start == i), key=lambda r: r.cluster)
            s.cost = sum(r.cost for r in own)
            s.move(np.array([r.sums for r in own]))
    blocks.unpersist()


def best_starts(vectors: DataFrame, ks: Iterable[int], restarts: int = 20, seed: int = 42) -> dict[int, KMeansModel]:
    """For each number of clusters the run of least cost among several starts; of equals the first.

    MLlib draws every start's first centres (a fit without iterations), all starts are settled in shared passes, and
    MLlib fits the best one, so models are its own.
    """

    def drawn(asked: tuple[int, int]) -> Start:
        k, start = asked
        return Start(k, seed + start, np.array(_kmeans(k, seed + start, 0).fit(vectors).clusterCenters()))

    ks = list(ks)
    with ThreadPoolExecutor(8) as pool:
        starts = list(pool.map(drawn, [(k, start) for k in ks for start in range(restarts)]))
        settle(vectors, starts)
        chosen = []
        for k in ks:
            own = [s for s in starts if s.k == k]
            least = min(s.cost for s in own)
            chosen.append(next(s for s in own if s.cost <= least * (1 + 1e-9)))
        return dict(zip(ks, pool.map(lambda s: _kmeans(s.k, s.seed).fit(vectors), chosen)))


def best_kmeans(vectors: DataFrame, k: int, restarts: int = 20, seed: int = 42) -> KMeansModel:
    """The run of least cost among several starts."""
    return best_starts(vectors, [k], restarts, seed)[k]


def silhouette(clustered: DataFrame) -> float:
    """Mean silhouette on squared distances, whose sums factor per cluster."""
    return ClusteringEvaluator(featuresCol="scaled", predictionCol="cluster_id").evaluate(clustered)


def k_scores(
    vectors: DataFrame, ks: Iterable[int], restarts: int = 20, seed: int = 42
) -> tuple[DataFrame, dict[int, KMeansModel]]:
    """Inertia and silhouette per number of clusters, and the models."""
    models = best_starts(vectors, ks, restarts, seed)
    rows = [(k, float(model.summary.trainingCost), silhouette(model.transform(vectors))) for k, model in models.items()]
    schema = "k int, inertia double, silhouette double"
    return vectors.sparkSession.createDataFrame(rows, schema), models


def best_k(scores: DataFrame) -> DataFrame:
    """The number of clusters of highest silhouette; the smallest wins a tie."""
    top = F.min(F.struct((-F.col("silhouette")).alias("s"), F.col("k").alias("k")))
    return scores.agg(top.alias("top")).select(
        F.col("top.k").alias("k"), (-F.col("top.s")).alias("silhouette")
    )


def candidate_ks(rows: int, most: int = 9) -> range:
    return range(2, min(most + 1, rows))


def with_coordinates(vectors: DataFrame) -> DataFrame:
    """First two principal components of ``scaled``.

    Each axis points to where its largest loading is positive.
    """
    if vectors.limit(2).count() < 2:
        return vectors.withColumns({"PC1": F.lit(0.0), "PC2": F.lit(0.0)})
    model = PCA(k=2, inputCol="scaled", outputCol="pcs").fit(vectors)
    loadings = model.pc.toArray()
    signs = [1.0 if axis[np.abs(axis).argmax()] >= 0 else -1.0 for axis in loadings.T]
    placed = vectors_to_axes(model.transform(vectors), signs)
    return placed.drop("pcs")


def vectors_to_axes(projected: DataFrame, signs: Sequence[float]) -> DataFrame:
    parts = vector_to_array("pcs")
    return projected.withColumns(
        {f"PC{i + 1}": parts[i] * sign for i, sign in enumerate(signs)}
    )


def ensure_coordinates(products: DataFrame) -> DataFrame:
    """Coordinates for products that have none yet; 0 where they cannot be."""
    if len(present(products, ["PC1", "PC2"])) == 2:
        have = products.agg(F.count("PC1"), F.count("PC2")).first()
        if min(have) > 0:
            return products
        products = products.drop("PC1", "PC2")
    if len(present(products, lexicon.SEGMENT_FEATURES)) < 2:
        return products.withColumns({"PC1": F.lit(0.0), "PC2": F.lit(0.0)})
    columns = feature_columns(products)
    filled = with_features(products)
    return with_coordinates(with_vector(filled, columns)).drop("scaled")


def explore_coordinates(products: DataFrame, brand: str | None = None) -> DataFrame:
    """Coordinates within one brand over nine features, gaps as 0."""
    if brand is not None:
        products = products.where(F.col("Brand") == brand)
    columns = feature_columns(products, lexicon.EXPLORE_FEATURES)
    filled = with_features(products, lexicon.EXPLORE_FEATURES, "zero")
    return with_coordinates(with_vector(filled, columns)).drop("scaled")


def segment_products(
    products: DataFrame, ks: Iterable[int] | None = None, restarts: int = 20, seed: int = 42
) -> tuple[DataFrame, DataFrame, KMeansModel]:
    """Products with cluster, segment name and coordinates; scores; the model."""
    columns = feature_columns(products)
    filled = with_features(products)
    vectors = stage(with_vector(filled, columns), "vectors", even=True).persist()
    if ks is None:
        ks = candidate_ks(vectors.limit(10).count())
    scores, models = k_scores(vectors, ks, restarts, seed)
    chosen = models[best_k(scores).first()["k"]]
    vectors.unpersist()  # the stored table serves what is left to read
    clustered = with_coordinates(with_segment(chosen.transform(vectors))).drop("scaled")
    return clustered, scores, chosen
