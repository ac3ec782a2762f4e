"""The active-learning loop: sample, label, train, predict, keep the survivors, again.

Every iteration commits its splits, labels and survivors under a manifest, so a run that was stopped goes on with the
first iteration that is not complete, and what an interrupted one has written is not seen.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.functions import training
from siftspark.operators import evaluation, filters, sampling
from siftspark.sources import commits


@dataclass(frozen=True)
class LoopConfig:
    """``sample``: rows to label in an iteration, split r : 1 : 1 in the first and in thirds later; ``hit_share``: share of the labelled
    scores that count as hits; ``last_share``: in the last of several iterations, or 100 of them for None."""

    folder: str
    iterations: int = 3
    sample: int = 3000
    train_ratio: float = 3.0
    hit_share: float = 0.1
    last_share: float | None = 0.01
    recall: float = 0.9
    seed: int = 11


def _stored(df_of: Callable[[], DataFrame], spark: SparkSession, path: str) -> DataFrame:
    commits.append(df_of, path, "all")
    return commits.read(spark, path)


def evaluation_label(score: Column, cutoff: float) -> Column:
    """1 for a hit, else 0."""
    return filters.is_hit(score, cutoff).cast("double")


def run(library: DataFrame, label: Callable[[DataFrame], DataFrame], config: LoopConfig) -> DataFrame:
    """(id, features, p) of the last iteration's survivors.

    ``library``: id and features (array<double>). ``label``: gives ids their score, lower being better.
    """
    spark = library.sparkSession
    left, labelled = library, None
    for i in range(1, config.iterations + 1):
        here = f"{config.folder}/iteration={i}"
        total = left.count()
        sizes = sampling.split_ratio(min(config.sample, total), config.train_ratio if i == 1 else None)
        shards = left.withColumn("_shard", F.lit(0))
        wanted = spark.createDataFrame([(0, *sizes)], "_shard int, n_train bigint, n_valid bigint, n_test bigint")
        fresh = _stored(lambda s=shards, w=wanted, k=i: label(sampling.stratified_split(s, "_shard", "id", w, config.seed + k).drop("_shard")), spark, f"{here}/labels")
        if i > 1:  # later iterations train on all that they label; valid and test stay those of the first
            fresh = fresh.withColumn("split", F.lit("train"))
        labelled = fresh if labelled is None else labelled.unionByName(fresh.join(labelled.select("id"), "id", "left_anti"))
        valid = labelled.filter("split = 'valid'")
        n_valid = valid.count()
        first, last = int(n_valid * config.hit_share), sampling.last_hits(n_valid, config.last_share)
        good = last if i == config.iterations > 1 else sampling.linear_schedule(first, last, i, config.iterations)
        cutoff = evaluation.lowered_cutoff(valid, "score", max(1, good)).first()["cutoff"]
        rows = labelled.withColumn("label", evaluation_label(F.col("score"), cutoff))
        train = sampling.rebalance(rows.filter("split = 'train'"), "label", "id", config.seed)
        model = training.train(train, steps=50)
        scored = lambda df, m=model: training.scored(m, df)
        at = evaluation.threshold_at_recall(scored(rows.filter("split = 'valid'")), "p", "label", config.recall).first()
        threshold = at["threshold"] if at["threshold"] is not None else 0.0
        left = _stored(lambda df=left, s=scored, t=threshold: s(df).filter(F.col("p") >= t).select("id", "features", "p"), spark, f"{here}/survivors").drop("p" if i < config.iterations else "_none")
    return left
