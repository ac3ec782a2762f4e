"""Predicates over property, endpoint, vote and score tables.

NaN counts as missing everywhere, and a missing value never passes a test.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Bounds = Mapping[str, tuple[float | None, float | None]]

# The default physico-chemical bounds.
PHYSCHEM_BOUNDS: Bounds = {
    "MW": (200, 600),
    "LogP": (0, 5),
    "nHA": (None, 12),
    "nHD": (None, 5),
    "nRot": (None, 11),
    "nRing": (None, 6),
    "MaxRing": (None, 18),
    "nStereo": (None, 2),
    "TPSA": (None, 140),
    "QED": (0.4, None),
    "SAscore": (None, 5),
}
PROPERTY_SETS = {
    "ro5": ("nHA", "nHD", "LogP", "MW"),
    "phychem": ("nHA", "nHD", "LogP", "MW", "nRot", "nRing", "MaxRing", "nStereo", "TPSA"),
    "medchem": ("SAscore", "QED"),
    "all": ("nHA", "nHD", "LogP", "MW", "nRot", "nRing", "MaxRing", "nStereo", "TPSA", "SAscore", "QED"),
}


def known(c: Column | str) -> Column:
    """Not null and not NaN."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & ~F.isnan(c.cast("double"))


def within(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """low <= c <= high, where an open or infinite side is no test; false for missing values."""
    tests = [known(c)]
    if low is not None and low != float("-inf"):
        tests.append(c >= low)
    if high is not None and high != float("inf"):
        tests.append(c <= high)
    return F.coalesce(reduce(and_, tests), F.lit(False))


def passed(bounds: Bounds) -> Column:
    """How many of the bounds a row keeps."""
    return reduce(lambda a, b: a + b, [within(F.col(f"`{c}`"), lo, hi).cast("int") for c, (lo, hi) in bounds.items()])


def property_vote(props: DataFrame, bounds: Bounds = PHYSCHEM_BOUNDS, least: int | None = None) -> DataFrame:
    """Rows that keep at least ``least`` of the bounds (all of them by default)."""
    return props.filter(passed(bounds) >= (len(bounds) if least is None else least))


def select_properties(props: DataFrame, name: str, key: str = "name") -> DataFrame:
    return props.select(key, *PROPERTY_SETS[name])


def all_within(endpoints: DataFrame, bounds: Bounds) -> DataFrame:
    """Rows that keep every bound; an endpoint without limits must still be known."""
    return endpoints.filter(reduce(and_, [within(F.col(f"`{c}`"), lo, hi) for c, (lo, hi) in bounds.items()]))


def votes(columns: Sequence[str], over: float = 0.5) -> Column:
    """How many of the columns lie strictly above ``over``."""
    return reduce(lambda a, b: a + b, [F.coalesce(known(c) & (F.col(f"`{c}`") > over), F.lit(False)).cast("int") for c in columns])


def vote_filter(predictions: DataFrame, columns: Sequence[str], least: int = 3, over: float = 0.5) -> DataFrame:
    return predictions.withColumn("votes", votes(columns, over)).filter(F.col("votes") >= least)


def share_true(*conditions: Column) -> Column:
    """Fraction of the conditions that hold."""
    return reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(False)).cast("double") for c in conditions]) / len(conditions)


def rule_scores() -> dict[str, Column]:
    """Fractions of each rule's conditions that a descriptor row meets. The thresholds are fixed values."""
    c = F.col
    donors_acceptors = c("naccr") + c("ndonr")
    return {
        "Lipinski": share_true(c("MW") <= 500, c("LogP") <= 5, c("naccr") <= 10, c("ndonr") <= 5),
        "Ghose": share_true(
            (c("LogP") > 0.4) & (c("LogP") < 5.6), (c("MW") > 160) & (c("MW") < 480), (c("MR") > 40) & (c("MR") < 130), (c("nta") > 20) & (c("nta") < 70)
        ),
        "Oprea": share_true(c("nring") >= 3, c("nrigidbond") >= 18, c("nRotbond") >= 6),
        "Veber": share_true(c("nRotbond") <= 10, (c("TPSA") <= 140) | (donors_acceptors <= 12)),
        "Varma": share_true(
            c("MW") <= 500, c("TPSA") <= 125, (c("`LogD7.4`") > 2) & (c("`LogD7.4`") < 5), donors_acceptors <= 9, c("nRotbond") <= 12
        ),
    }


def finite_features(features: str) -> Column:
    """Whether an array has no null, NaN or infinite entry."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return ~F.exists(features, odd)


def guarded_prediction(features: str, prediction: Column) -> Column:
    """The prediction, or null where the features are not finite."""
    return F.when(finite_features(features), prediction)


def single_component(smiles: Column) -> Column:
    return ~smiles.contains(".")


def unmixed(mols: DataFrame, column: str = "smiles") -> DataFrame:
    """Drop mixtures; of equal fragments one stays."""
    parts = F.array_distinct(F.split(column, "\\."))
    return mols.filter(F.size(parts) == 1).withColumn(column, F.get(parts, F.lit(0)))


def both(pairs: DataFrame, test, a: str = "a", b: str = "b") -> DataFrame:  # noqa: ANN001
    """Pairs of which both members pass ``test``, a function of a struct column."""
    return pairs.filter(test(F.col(a)) & test(F.col(b)))


def numeric(df: DataFrame, *columns: str) -> DataFrame:
    """Cast to double; rows where a cast fails or gives NaN go."""
    for c in columns:
        value = F.expr(f"try_cast(`{c}` AS DOUBLE)")
        df = df.withColumn(c, F.when(~F.isnan(value), value))
    return df.na.drop(subset=list(columns))


def survivors(predictions: DataFrame, scores: str, thresholds: Sequence[float]) -> DataFrame:
    """Rows of which any model's score is above its threshold; all scores and their mean stay."""
    limit = F.array(*[F.lit(float(t)) for t in thresholds])
    mean = F.aggregate(scores, F.lit(0.0), lambda a, x: a + x) / F.size(scores)
    return predictions.filter(F.exists(F.zip_with(scores, limit, lambda p, t: p > t), lambda x: x)).withColumn("mean_score", mean)


def consensus(scores: Column, thresholds: Column, n: int) -> Column:
    """Whether more than half of the models reach their threshold."""
    hits = F.aggregate(F.zip_with(scores, thresholds, lambda p, t: (p >= t).cast("int")), F.lit(0), lambda a, x: a + x)
    return hits > n // 2


def at_most(df: DataFrame, column: str, limit: int) -> DataFrame:
    """Rows whose text is a whole number of at most ``limit``; the others are no error."""
    return df.filter(F.regexp_like(F.trim(column), F.lit("^[+-]?[0-9]+$")) & (F.expr(f"try_cast(trim(`{column}`) AS BIGINT)") <= limit))


def without_nan(df: DataFrame, features: str) -> DataFrame:
    """Rows without NaN or null among their features."""
    return df.filter(~F.exists(features, lambda x: x.isNull() | F.isnan(x)))


def light(weight: Column, most: float = 1000.0) -> Column:
    return F.coalesce(weight <= most, F.lit(False))


def large_enough(atoms: Column, least: int = 6) -> Column:
    """By atoms, hydrogens included."""
    return F.coalesce(atoms >= least, F.lit(False))


def arranged(df: DataFrame, names: Mapping[str, str], order: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """Columns renamed and in order; optional ones are left out where they are missing or have no value at all."""
    renamed = df.withColumnsRenamed(dict(names))
    there = [c for c in optional if c in renamed.columns]
    if there:
        filled = renamed.agg(*[F.count(c).alias(c) for c in there]).first()
        there = [c for c in there if filled[c]]
    return renamed.select(*[c for c in order if c in there or c not in optional])


def with_key_bonds(hbonds: DataFrame) -> DataFrame:
    """Ligands with a hydrogen bond to a key residue."""
    return hbonds.filter("key_residue_hbonds > 0")


def is_hit(score: Column, cutoff: float) -> Column:
    return score < cutoff


def matches_any(docs: DataFrame, column: str, patterns: Sequence[str]) -> DataFrame:
    """A 0/1 column per pattern (m0, m1, ...) and whether any matches, by substring."""
    tests = [F.coalesce(F.contains(column, F.lit(p)), F.lit(False)) for p in patterns]
    return docs.select("*", *[t.cast("int").alias(f"m{i}") for i, t in enumerate(tests)], reduce(or_, tests).alias("any_match"))
