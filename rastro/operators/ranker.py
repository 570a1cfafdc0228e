"""A second ranker: a neural network over pairs of learned vectors.

Its inputs are the element-wise product of a user's and an item's factors and
both factors themselves; it is trained with log-loss on sampled negatives.
"""

from __future__ import annotations

from pyspark.ml.classification import (
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastro.session import spread

# Widths of the hidden layers.
HIDDEN_LAYERS = [64, 32, 16]

# Pairs are narrow and their features wide: this many become one task's block.
PAIRS_PER_TASK = 100_000


def pair_features(
    pairs: DataFrame, user_factors: DataFrame, item_factors: DataFrame
) -> DataFrame:
    left = user_factors.select(F.col("id").cast("bigint").alias("u_idx"), F.col("features").alias("_u"))
    right = item_factors.select(F.col("id").cast("bigint").alias("i_idx"), F.col("features").alias("_i"))
    product = F.zip_with("_u", "_i", lambda a, b: a * b)
    joined = pairs.join(left, "u_idx").join(right, "i_idx")
    values = F.concat(product, F.col("_u"), F.col("_i")).cast("array<double>")
    return joined.select(*pairs.columns, array_to_vector(values).alias("features"))


def fit_ranker(
    pairs: DataFrame,
    user_factors: DataFrame,
    item_factors: DataFrame,
    factors: int,
    iterations: int = 100,
    seed: int = 42,
) -> MultilayerPerceptronClassificationModel:
    """Train on (u_idx, i_idx, label) rows of a pinned table.

    The pairs are spread before they get their features, by their number and
    not by their bytes, as a pair grows about sixtyfold.
    """
    data = pair_features(spread(pairs, PAIRS_PER_TASK), user_factors, item_factors)
    network = MultilayerPerceptronClassifier(
        layers=[3 * factors, *HIDDEN_LAYERS, 2],
        featuresCol="features",
        labelCol="label",
        maxIter=iterations,
        seed=seed,
    )
    return network.fit(data.select("features", "label"))


def score_with_ranker(
    model: MultilayerPerceptronClassificationModel,
    pairs: DataFrame,
    user_factors: DataFrame,
    item_factors: DataFrame,
) -> DataFrame:
    """Add ``score``, the probability of an interaction."""
    scored = model.transform(pair_features(pairs, user_factors, item_factors))
    return scored.select(*pairs.columns, vector_to_array("probability")[1].alias("score"))
