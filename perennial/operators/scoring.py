"""Score vectors to predictions, and predictions to evaluation figures."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perennial.functions import paths, vectors
from perennial.operators import vocabulary
from perennial.session import stage


def predict(scores: DataFrame) -> DataFrame:
    """Best class and its score per row."""
    return scores.withColumn("predicted_id", vectors.best_index(F.col("scores"))).withColumn(
        "confidence", vectors.best_score(F.col("scores"))
    )


def decode(predictions: DataFrame, label_map: DataFrame) -> DataFrame:
    """Name the predicted class; an id outside the vocabulary has no name.

    Versions can have vocabularies of their own: a label map with a
    ``model_version`` column names the predictions of each version by its rows.
    """
    if "model_version" in label_map.columns:
        own = label_map.select(
            "model_version", F.col("label_id").alias("predicted_id"), F.col("class_name").alias("predicted")
        )
        return predictions.join(own, ["model_version", "predicted_id"], "left")
    names = vocabulary.names_of(label_map).withColumnRenamed("label_id", "predicted_id")
    return predictions.join(names.withColumnRenamed("label_name", "predicted"), "predicted_id", "left")


def score_with(
    rows: DataFrame,
    load_model: Callable[[], Callable[[pd.DataFrame], pd.Series]],
    columns: list[str],
) -> DataFrame:
    """Add ``scores`` from any model, in Arrow batches.

    ``load_model`` runs once per task and returns a function from a batch to one
    score list per row.
    """
    out = rows.select(*columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for batch in batches:
            yield batch.assign(scores=model(batch))

    return out.mapInPandas(run, schema + ", scores array<double>")


def evaluate(scores: DataFrame, k: int = 5) -> DataFrame:
    """Accuracy, top-k accuracy and mean cross-entropy in one pass."""
    s, label = F.col("scores"), F.col("label")
    return scores.agg(
        F.avg(vectors.is_top_1(s, label).cast("double")).alias("accuracy"),
        F.avg(vectors.is_top_k(s, label, k).cast("double")).alias("top_k_accuracy"),
        F.avg(vectors.cross_entropy(s, label)).alias("cross_entropy"),
    )


def centroids(vectors_: DataFrame, vector: str = "embedding", label: str = "label") -> DataFrame:
    """Mean vector per label: one small row per label and dimension leaves each task. No label, no class."""
    cells = vectors_.where(F.col(label).isNotNull()).select(
        F.col(label).alias("label"), F.posexplode(F.col(vector)).alias("pos", "x")
    )
    means = cells.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "m")))
    return means.groupBy("label").agg(F.transform(ordered, lambda e: e["m"]).alias("centroid"))


# Most bytes of centroids that are sent to every task at once.
CENTROID_BYTES = 64 << 20


def nearest_centroid(
    rows: DataFrame, centers: DataFrame, vector: str = "embedding", name: str = "predicted_id", limit: int = CENTROID_BYTES
) -> DataFrame:
    """Label of the closest centroid; the lowest label wins a tie, a null vector has none.

    A row's own length is the same for all centroids, so ``|c|^2 - 2 v.c`` ranks
    them: one matrix product for each Arrow batch. Rows are neither joined nor
    shuffled. The centroids, classes x dimensions numbers, go to every task in
    blocks of about ``limit`` bytes, dealt by a hash of the label. Beyond one
    block the rows are stored after each with their best label so far: the
    driver holds one block at a time and never a list of the labels. Centroids
    without a label are no class; without any centroid no row has a label.
    """
    known = centers.where(F.col("label").isNotNull() & F.col("centroid").isNotNull())
    stored = stage(known.select("label", "centroid"), "centroids")
    total, n = stored.agg(F.coalesce(F.sum(F.size("centroid") * 8), F.lit(0)), F.count("*")).first()
    blocks = max(1, min(n, -(-total // limit)))
    out, low = rows.drop(name), "_low"
    for number in range(blocks):
        part = stored.where(F.pmod(F.xxhash64("label"), F.lit(blocks)) == number) if blocks > 1 else stored
        block = sorted((r["label"], r["centroid"]) for r in part.collect())
        if number and not block:
            continue
        out = _nearest_of(out, block, vector, name, low, number)
        if number < blocks - 1:
            out = stage(out, "nearest")
    return out.drop(low)


def _nearest_of(rows: DataFrame, known: list[tuple], vector: str, name: str, low: str, number: int) -> DataFrame:
    """Set label and rank value of the closest of these centroids where it is closer than the one the row has."""
    labels = np.array([label for label, _ in known])
    matrix = np.array([center for _, center in known], dtype=float).reshape(len(known), -1) if known else np.zeros((0, 1))
    norms = (matrix**2).sum(axis=1)
    kept = rows.drop(name, low) if number == 0 else rows
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields if f.name not in (name, low)]
    schema = ", ".join([*fields, f"`{name}` int", f"`{low}` double"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = pd.Series(pd.NA, index=batch.index, dtype="Int32") if number == 0 else batch[name].astype("Int32")
            value = pd.Series(np.inf, index=batch.index) if number == 0 else batch[low]
            there = batch[vector].notna()
            if there.any() and len(labels):
                points = np.stack(batch.loc[there, vector]).astype(float)
                ranks = norms - 2 * points @ matrix.T
                at = ranks.argmin(axis=1)
                least = ranks[np.arange(len(at)), at]
                before, best = value[there].to_numpy(), labels[at]
                held = found[there].fillna(np.iinfo(np.int32).max).to_numpy(np.int64)
                closer = (least < before) | ((least == before) & (best < held))
                places = np.flatnonzero(there.to_numpy())[closer]
                found.iloc[places] = labels[at[closer]]
                value.iloc[places] = least[closer]
            yield batch.assign(**{name: found, low: value})

    return kept.mapInPandas(run, schema)


def routed(log: DataFrame, at: str = "ts", row_id: str = "event_id") -> DataFrame:
    """Where the images of a prediction log are kept; the base version keeps none.

    A missing verdict counts as incorrect.
    """
    kept = log.filter(F.col("model_version") != "v3_0")
    stem = paths.stored_stem(
        F.col("model_version"),
        F.col("is_correct"),
        F.col("predicted"),
        F.col("actual"),
        F.col(at),
        F.col(row_id),
    )
    return kept.withColumn("outcome", paths.outcome_for(F.col("is_correct"))).withColumn("path", stem)
