"""Scoring with trained models: a catalogue of model files, loaded once in each worker, over Arrow batches.

What a file holds is up to ``load``, a function from a path to a callable that maps a matrix of features to scores
or representations. The loader that comes with this package reads linear, logistic, dense and tree models from JSON:
``{"kind": "logistic", "weights": [...], "bias": 0.0}``; ``{"kind": "dense", "layers": [{"weights": [[...]], "bias": [...]}, ...]}``
as :mod:`siftspark.functions.networks` writes it; ``{"kind": "trees", "trees": [{"feature": [...], "threshold": [...], "left": [...],
"right": [...], "value": [...]}, ...], "base": 0.0, "squash": true}``, where a node's feature of -1 marks a leaf.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftspark.functions import networks
from siftspark.session import find_package

Model = Callable[[np.ndarray], np.ndarray]


class Trees:
    """The sum of the leaves that a row reaches in each tree; rows go left up to the threshold."""

    def __init__(self, spec: dict) -> None:
        self.trees = [{k: np.asarray(t[k], float if k in ("threshold", "value") else int) for k in ("feature", "threshold", "left", "right", "value")} for t in spec["trees"]]
        self.base, self.squash = float(spec.get("base", 0.0)), bool(spec.get("squash"))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for t in self.trees:
            node = np.zeros(len(x), int)
            while len(open_ := np.flatnonzero(t["feature"][node] >= 0)):
                at = node[open_]
                left = x[open_, t["feature"][at]] <= t["threshold"][at]
                node[open_] = np.where(left, t["left"][at], t["right"][at])
            total += t["value"][node]
        return 1 / (1 + np.exp(-total)) if self.squash else total


def from_json(text: str) -> Model:
    """A linear, logistic, dense or tree model."""
    spec = json.loads(text)
    if spec["kind"] == "dense":
        return networks.from_spec(spec)
    if spec["kind"] == "trees":
        return Trees(spec)
    weights, bias = np.asarray(spec["weights"], float), float(spec.get("bias", 0.0))
    if spec["kind"] not in ("linear", "logistic"):
        raise ValueError(f"unknown model {spec['kind']}")
    return (lambda x: x @ weights + bias) if spec["kind"] == "linear" else (lambda x: 1 / (1 + np.exp(-(x @ weights + bias))))


def load_json(path: str) -> Model:
    """The model in a file that the workers can read."""
    with open(path) as f:
        return from_json(f.read())


def guarded(model: Model, x: np.ndarray) -> np.ndarray:
    """Scores; rows with a value that is not finite are scored as zeros and then set to NaN."""
    bad = ~np.isfinite(x).all(axis=1)
    return np.where(bad, np.nan, np.asarray(model(np.where(bad[:, None], 0.0, x)), float))


def ensemble(df: DataFrame, catalogue: dict[str, Sequence[str]], features: str | dict[str, str], load: Callable[[str], Model] = load_json, key: str = "name") -> DataFrame:
    """(key, one column per property): the mean score of a property's models for each row.

    ``catalogue``: the model paths of each property, a list made by hand. ``features``: the array column of all
    properties, or of each. Rows with features that are not finite get null.
    """
    find_package(df.sparkSession)
    column_of = {p: features if isinstance(features, str) else features[p] for p in catalogue}
    columns = sorted(set(column_of.values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = {p: [load(path) for path in paths] for p, paths in catalogue.items()}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = {c: networks.matrix(batch.column(c)) for c in columns}
            means = [pa.array(np.mean([guarded(model, x[column_of[p]]) for model in mine], axis=0)) for p, mine in models.items()]
            yield pa.record_batch([batch.column(key), *means], names=[key, *models])

    schema = f"{key} {dict(df.dtypes)[key]}, " + ", ".join(f"`{p}` double" for p in catalogue)
    scored = df.select(key, *columns).mapInArrow(run, schema)
    return scored.select(key, *[F.when(~F.isnan(f"`{p}`"), F.col(f"`{p}`")).alias(p) for p in catalogue])


def represent(df: DataFrame, features: str, layers: dict[str, str], load: Callable[[str], Model] = load_json, key: str = "name") -> DataFrame:
    """(key, one array column per layer): what models give for each row, for export."""
    find_package(df.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = {p: load(path) for p, path in layers.items()}
        for batch in batches:
            x = np.stack([np.asarray(row, float) for row in batch[features]]) if len(batch) else np.zeros((0, 1))
            yield pd.DataFrame({key: batch[key]} | {p: [np.atleast_1d(v).astype(float) for v in model(x)] if len(batch) else [] for p, model in models.items()})

    return df.select(key, features).mapInPandas(run, f"{key} {dict(df.dtypes)[key]}, " + ", ".join(f"`{p}` array<double>" for p in layers))


def logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def pair_scores(pairs: DataFrame, scores: DataFrame, a: str = "a", b: str = "b", key: str = "name", score: str = "score") -> DataFrame:
    """Add difference: how much better the second member of a pair scores than the first, in log-odds."""
    side = lambda k: scores.select(F.col(key).alias(k), logit(F.col(score)).alias(f"_{k}"))
    return pairs.join(side(a), a).join(side(b), b).withColumn("difference", F.col(f"_{b}") - F.col(f"_{a}")).drop(f"_{a}", f"_{b}")
