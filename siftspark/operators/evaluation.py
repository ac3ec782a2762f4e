"""Curves, metrics and model selection. Ties in a score count together, and only distinct scores are sorted."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftspark.operators.filters import consensus
from siftspark.operators.ordering import numbered, running_extreme, running_sums


def _by_score(df: DataFrame, score: str, label: str) -> DataFrame:
    """(threshold, tp, fp, p, n): for each distinct score its positives and negatives, and those from the highest score down to it."""
    rows = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    by = rows.groupBy(F.col(score).alias("threshold")).agg(F.sum(F.col(label).cast("bigint")).alias("p"), F.sum(1 - F.col(label).cast("bigint")).alias("n"))
    return running_sums(by, [F.desc("threshold")], ["p", "n"]).withColumnsRenamed({"p_sum": "tp", "n_sum": "fp"})


def cumulative(df: DataFrame, score: str, label: str) -> DataFrame:
    """(threshold, tp, fp, n_pos, n_neg) for each distinct score, from the highest down."""
    by = _by_score(df, score, label)
    every = by.agg(F.sum("p").alias("n_pos"), F.sum("n").alias("n_neg"))
    return by.select("threshold", "tp", "fp").crossJoin(F.broadcast(every))


def pr_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    c = cumulative(df, score, label)
    return c.select("threshold", (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), F.coalesce(F.try_divide("tp", "n_pos"), F.lit(0.0)).alias("recall"))


def threshold_at_recall(df: DataFrame, score: str, label: str, recall: float) -> DataFrame:
    """One row: the largest threshold whose recall lies above the target, with precision and recall there."""
    above = pr_curve(df, score, label).filter(F.col("recall") > recall)
    return above.agg(F.max("threshold").alias("threshold"), F.max_by("precision", "threshold").alias("precision"), F.max_by("recall", "threshold").alias("recall"))


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row: the area under the curve, null where a class is missing.

    Each negative counts the positives above it, and half of those that tie.
    """
    pairs = _by_score(df, score, label).select("p", "n", (F.col("n") * (2 * F.col("tp") - F.col("p"))).alias("twice"))
    return pairs.agg(F.try_divide(F.sum("twice").cast("double"), (2 * F.sum("p") * F.sum("n")).cast("double")).alias("auc"))


def task_aucs(df: DataFrame, tasks: Mapping[str, tuple[str, str]]) -> DataFrame:
    """(task, auc) from the score and label column of each task, on the rows that have both; tasks with one class are left out."""
    parts = [roc_auc(df.filter(~F.isnan(F.col(s).cast("double")) & ~F.isnan(F.col(y).cast("double"))), s, y).select(F.lit(k).alias("task"), "auc") for k, (s, y) in tasks.items()]
    return reduce(DataFrame.unionByName, parts).filter(F.col("auc").isNotNull())


def consensus_report(df: DataFrame, scores: Sequence[str], thresholds: Sequence[float], label: str) -> DataFrame:
    """One row: precision and recall of the vote of more than half of the models, and the counts behind them."""
    hit = consensus(F.array(*scores), F.array(*[F.lit(float(t)) for t in thresholds]), len(scores)).cast("int")
    return confusion(df.withColumn("_hit", F.coalesce(hit, F.lit(0))), label, "_hit").select("tp", "fp", "fn", "precision", "recall")


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """One row of counts and metrics; a metric without a denominator is null."""
    y, p = F.col(label) == 1, F.col(predicted) == 1
    c = df.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(~y & ~p).alias("tn"), F.count_if(y & ~p).alias("fn"))
    tp, fp, tn, fn = (F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn"))
    c = c.select("*", F.try_divide(tp, tp + fn).alias("recall"), F.try_divide(tp, tp + fp).alias("precision"), F.try_divide(tn, tn + fp).alias("specificity"), F.try_divide(tn, tn + fn).alias("npv"))
    f_beta = lambda b: F.try_divide((1 + b * b) * tp, (1 + b * b) * tp + b * b * fn + fp)
    c = c.select("*", f_beta(1).alias("f1"), f_beta(2).alias("f2"), F.try_divide(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))).alias("mcc"))
    return c.withColumn("scaled_performance", (F.col("precision") * F.col("precision") + F.col("f1") * F.col("f1")) / 2)


# Fixed value: what each million parameters divides the scaled performance by.
SIZE_PENALTY = 1.03


def size_penalised(scaled: Column, precision: Column, parameters: int) -> tuple[Column, Column]:
    """Scaled performance and precision, less for larger models."""
    millions = parameters / 1e6
    return scaled / (SIZE_PENALTY**millions), precision / millions


def equal_error_rate(df: DataFrame, score: str, label: str, steps: int = 1000) -> DataFrame:
    """One row: the first grid threshold where false alarms fall below misses, and the mean of both rates there."""
    cell = F.least(F.greatest(F.floor(F.col(score) * steps + 1e-9), F.lit(-1)), F.lit(steps)).cast("int")
    counts = df.groupBy(cell.alias("cell")).agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n"))
    grid = df.sparkSession.range(-1, steps + 1).select(F.col("id").cast("int").alias("cell"))
    filled = grid.join(counts, "cell", "left").na.fill(0)
    below = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rates = filled.select("cell", (1 - F.try_divide(F.coalesce(F.sum("n").over(below), F.lit(0)), F.sum("n").over(whole))).alias("fpr"), F.try_divide(F.coalesce(F.sum("p").over(below), F.lit(0)), F.sum("p").over(whole)).alias("fnr"))
    first = rates.filter("cell >= 0 AND fpr < fnr").agg(F.min("cell").alias("cell"), F.min_by("fpr", "cell").alias("fpr"), F.min_by("fnr", "cell").alias("fnr"))
    return first.select((F.col("cell") / steps).alias("threshold"), ((F.col("fpr") + F.col("fnr")) / 2).alias("eer"))


def recall_cutoff(models: DataFrame, target: float, by: str = "cutoff", recall: str = "re_te") -> DataFrame:
    """(by, thr): the target lowered in steps of 0.01 until over a quarter of the group's models reach it.

    The (n // 4 + 1)-th largest recall decides, so the number of steps is known at once.
    """
    place = F.row_number().over(Window.partitionBy(by).orderBy(F.desc(recall)))
    n = F.count("*").over(Window.partitionBy(by))
    edge = models.select(by, recall, place.alias("_i"), n.alias("_n")).filter(F.col("_i") == F.floor(F.col("_n") / 4) + 1)
    steps = F.greatest(F.lit(0), F.ceil(F.round((F.lit(target) - F.col(recall)) / 0.01, 9)))
    return edge.select(by, (F.lit(target) - 0.01 * steps).alias("thr"))


def recall_spread(models: DataFrame, by: str = "cutoff") -> DataFrame:
    """(by, mean_ratio, std_ratio) of validation recall over predicted recall; the deviation of one model is null."""
    ratio = F.col("re_vl") / F.col("re_pr")
    return models.groupBy(by).agg(F.avg(ratio).alias("mean_ratio"), F.stddev_samp(ratio).alias("std_ratio"))


def select_models(models: DataFrame, target: float, spread: float = 0.01, few_hits: int | None = None) -> DataFrame:
    """The best models of each cutoff by test precision: one where the recall ratio varies little, or where the column
    ``hits`` is at most ``few_hits``; else three."""
    stats = recall_spread(models).select("cutoff", F.col("std_ratio").alias("_sd"))
    reached = models.join(recall_cutoff(models, target), "cutoff").filter(F.col("re_te") >= F.col("thr") - 1e-12)
    place = F.row_number().over(Window.partitionBy("cutoff").orderBy(F.desc("pr_te"), "model_no"))
    best = reached.withColumn("place", place).join(stats, "cutoff")
    single = F.coalesce(F.col("_sd") < spread, F.lit(False))
    if few_hits is not None:
        single = single | (F.col("hits") <= few_hits)
    return best.filter(F.col("place") <= F.when(single, 1).otherwise(3)).drop("_sd", "thr")


def threshold_table(selected: DataFrame, predictions: DataFrame, recall: float) -> DataFrame:
    """(model_no, cutoff, threshold): for each selected model the largest threshold whose recall lies above the target.

    ``predictions``: (model_no, score, label). All models keep their row.
    """
    rows = predictions.join(F.broadcast(selected.select("model_no", "cutoff")), "model_no").filter("label IS NOT NULL AND score IS NOT NULL")
    by = rows.groupBy("model_no", "cutoff", "score").agg(F.sum(F.col("label").cast("bigint")).alias("p"))
    sums = running_sums(by, ["model_no", F.desc("score")], ["p"])
    before = by.groupBy("model_no").agg(F.sum("p").alias("_all"))
    earlier = before.select("model_no", "_all", (F.sum("_all").over(Window.orderBy("model_no").rowsBetween(Window.unboundedPreceding, -1))).alias("_before"))  # one row for each model
    reached = sums.join(F.broadcast(earlier), "model_no").filter((F.col("p_sum") - F.coalesce("_before", F.lit(0))) / F.col("_all") > recall)
    return reached.groupBy("model_no", "cutoff").agg(F.max("score").alias("threshold"))


def best_cutoff(cutoffs: DataFrame) -> DataFrame:
    """The cutoff with the fewest expected survivors; of equals the last."""
    return cutoffs.orderBy("expected", F.desc("cutoff")).limit(1)


def expected_survivors(recall: Column, positives: Column, precision: Column, library: Column, tested: Column) -> Column:
    return F.try_divide(recall * positives * library, precision * tested)


def lowered_cutoff(scores: DataFrame, score: str, good: int, step: float = 0.005) -> DataFrame:
    """One row (cutoff, n_below): the mean lowered in steps until at most ``good`` scores lie below it.

    That is so once the cutoff is no more than the (good + 1)-th smallest score, which is found among counted scores.
    """
    mean = scores.agg(F.avg(score).alias("mean"), F.count(score).alias("n"))
    by = scores.filter(F.col(score).isNotNull()).groupBy(F.col(score).alias("_s")).agg(F.count("*").alias("_n"))
    edge = running_sums(by, ["_s"], ["_n"]).filter(F.col("_n_sum") > good).agg(F.min("_s").alias("edge"))
    steps = F.when(F.col("n") > good, F.greatest(F.lit(1), F.ceil((F.col("mean") - F.col("edge")) / step))).otherwise(0)
    cutoff = mean.crossJoin(edge).select((F.col("mean") - steps * step).alias("cutoff"))
    return scores.crossJoin(F.broadcast(cutoff)).groupBy("cutoff").agg(F.count_if(F.col(score) < F.col("cutoff")).alias("n_below"))


# The hyper-parameter grid.
GRID = {
    "oversample": (10,),
    "batch_size": (256,),
    "learning_rate": (1e-4,),
    "n_layers": (2, 3),
    "n_units": (1500, 2000),
    "dropout": (0.2, 0.5),
    "class_weight": (2.0, 3.0),
}


def hyper_grid(spark, grid: dict[str, tuple] = GRID) -> DataFrame:  # noqa: ANN001
    """All combinations of a few literal values, numbered from 1."""
    rows = [(i, *values) for i, values in enumerate(product(*grid.values()), 1)]
    kinds = {int: "bigint", float: "double", str: "string"}
    return spark.createDataFrame(rows, "model_no int, " + ", ".join(f"{k} {kinds[type(v[0])]}" for k, v in grid.items()))


def grids_for(targets: DataFrame, grid: DataFrame) -> DataFrame:
    """Each row of the grid, a few literal combinations, for each target."""
    return targets.crossJoin(F.broadcast(grid)).select(*grid.columns, *targets.columns)


def job_specs(grid: DataFrame, command: str, **settings: str) -> DataFrame:
    """(model_no, command): a command line for each row of a grid, its columns and the settings as options."""
    options = [F.concat(F.lit(f" --{c.replace('_', '-')} "), F.col(c).cast("string")) for c in grid.columns]
    fixed = "".join(f" --{k.replace('_', '-')} {v}" for k, v in settings.items())
    return grid.select("model_no", F.concat(F.lit(command), *options, F.lit(fixed)).alias("command"))


def best_so_far(df: DataFrame, order: str, value: str, larger: bool = True, by: Sequence[str] = ()) -> DataFrame:
    """Add the running best of a metric series, and ``waited``: how many steps ago it was last reached (early stopping by patience).

    Several series at once with ``by``; a single one is worked out over ranges.
    """
    hit = F.when(F.col(value) == F.col("best"), F.col("_step"))
    if by:
        series = Window.partitionBy(*by).orderBy(order)
        so_far = series.rowsBetween(Window.unboundedPreceding, 0)
        marked = df.withColumn("best", (F.max if larger else F.min)(value).over(so_far)).withColumn("_step", F.row_number().over(series))
        return marked.withColumn("waited", F.col("_step") - F.max(hit).over(so_far)).drop("_step")
    marked = running_extreme(numbered(df, [order], "_step"), [order], value, "best", larger)
    return running_extreme(marked.withColumn("_hit", hit), [order], "_hit", "_last").withColumn("waited", F.col("_step") - F.col("_last")).drop("_step", "_hit", "_last")


def smoothed(df: DataFrame, order: str, value: str, width: int, by: Sequence[str] = ()) -> DataFrame:
    """Add smooth: the mean of this value and those before it, ``width`` at most."""
    if by:
        return df.withColumn("smooth", F.avg(value).over(Window.partitionBy(*by).orderBy(order).rowsBetween(1 - width, 0)))
    rows = numbered(df, [order], "_step")
    seen = rows.select(F.explode(F.sequence(F.col("_step"), F.col("_step") + width - 1)).alias("_step"), F.col(value).alias("_v"))
    return rows.join(seen.groupBy("_step").agg(F.avg("_v").alias("smooth")), "_step").drop("_step")


def stop_estimate(df: DataFrame, order: str, loss: str, width: int, by: Sequence[str] = ()) -> DataFrame:
    """One row (for each series): how many steps the smoothed loss has gone without a new least value at most, and how many it does so now."""
    marked = best_so_far(smoothed(df, order, loss, width, by), order, "smooth", False, by)
    return marked.groupBy(*by).agg(F.max("waited").alias("longest"), F.max_by("waited", order).alias("now"))


def mean_by(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Ensemble means over models or folds."""
    return df.groupBy(key).agg(*[F.avg(c).alias(c) for c in columns])


