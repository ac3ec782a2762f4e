"""Normalising, desirability and composite scores, ranking and summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftspark.operators import ordering, quantiles
from siftspark.session import checkpointed


def with_extremes(df: DataFrame, *columns: str) -> DataFrame:
    """Add the least and largest value of each column (_lo_c, _hi_c): one row, joined to all."""
    row = df.agg(*[f(c).alias(f"{p}_{c}") for c in columns for p, f in (("_lo", F.min), ("_hi", F.max))])
    return df.crossJoin(F.broadcast(row))


def min_max(c: Column, low: Column, high: Column, ascending: bool = True) -> Column:
    """Scale to 0..1, best at 1: the largest value, or the least. A constant column is 1 throughout."""
    span = F.nullif(high - low, F.lit(0.0))
    return F.when(c.isNotNull(), F.coalesce((c - low) / span if ascending else (high - c) / span, F.lit(1.0)))


def zscore_sigmoid(df: DataFrame, column: str, out: str, reverse: bool = False) -> DataFrame:
    """Logistic curve of the z-score; a constant column counts as having a deviation of 1e-6."""
    row = F.broadcast(df.agg(F.avg(column).alias("_mu"), F.coalesce(F.stddev_samp(column), F.lit(0.0)).alias("_sd")))
    z = (F.col(column) - F.col("_mu")) / F.when(F.col("_sd") == 0, 1e-6).otherwise(F.col("_sd"))
    return df.crossJoin(row).withColumn(out, 1 / (1 + F.exp(z if reverse else -z))).drop("_mu", "_sd")


@dataclass(frozen=True)
class Curve:
    """An asymmetric double sigmoid over its maximum."""

    a: float
    b: float
    c: float
    d: float
    e: float
    f: float
    dmax: float

    def of(self, x: Column) -> Column:
        rise = 1 / (1 + F.exp(-(x - self.c + self.d / 2) / self.e))
        fall = 1 - 1 / (1 + F.exp(-(x - self.c - self.d / 2) / self.f))
        return (self.a + self.b * rise * fall) / self.dmax


# The fitted desirability curves.
CURVES = {
    "LogS": Curve(3.834681062, 331.7185080, -5.02855163, 1e-12, 0.546000793, 1.561346702, 105.04624445),
    "LogD7.4": Curve(4.017324007, 74.96126374, 1.542432416, 3.478931599, 0.759632108, 0.236101674, 75.202927993),
    "LogP": Curve(0.387710147, 411.1685011, 3.668893958, 1e-12, 1.767115687, 0.976073627, 111.52745436),
    "Caco-2": Curve(5.612275853, 184.0800121, -4.80733516, 0.967814546, 0.274334263, 0.055076984, 175.40602369),
    "PPB": Curve(15.74469550, 357.6398954, 95.05358083, 1e-12, 6.620533189, 1.445048550, 139.49921185),
    "VD": Curve(2.902878950, 204.3114326, -0.44915155, 0.998337774, 0.153329122, 0.626545494, 140.32210262),
    "CL": Curve(3.034916400, 183.3315835, 1.377602783, 1.302744211, 0.140431449, 0.263092747, 173.27513895),
    "T1/2": Curve(3.794290591, 184.2565890, 1.714930942, 0.740145270, 0.293348712, 0.140594426, 138.68404392),
    "LD50": Curve(2.670244460, 529.3035013, 3.064084509, 1e-12, 0.207280955, 0.109411990, 147.30165182),
}
# The intervals that count as desirable (both ends open).
DESIRABLE = {
    "LogS": (-4.0, 0.5),
    "LogD7.4": (1.0, 5.0),
    "LogP": (0.0, 3.0),
    "Caco-2": (-5.15, None),
    "PPB": (None, 90.0),
    "VD": (0.04, 20.0),
    "CL": (5.0, None),
    "T1/2": (3.0, None),
    "LD50": (2.6989700043360187, None),
}
# Classes in which a low probability is desirable.
HARMFUL = frozenset(
    ("Pgp-inhibitor", "Pgp-substrate", "BBB", "CYP1A2-Inhibitor", "CYP2C19-Inhibitor", "CYP2C9-Inhibitor", "CYP2D6-Inhibitor", "CYP3A4-Inhibitor", "hERG", "H-HT", "Ames", "SkinSen")
)
# By endpoint, the quality of its model and its importance. LogP's quality is the mean of the others.
ENDPOINTS = {
    "LogS": (0.967, 1),
    "LogD7.4": (0.877, 1),
    "LogP": (None, 1),
    "Caco-2": (0.845, 0.8),
    "PPB": (0.691, 0.8),
    "VD": (0.904, 0.8),
    "CL": (0.897, 1),
    "T1/2": (0.824, 1),
    "LD50": (0.997, 1),
    "HIA": (0.773, 1),
    "F (20%)": (0.671, 0.5),
    "F (30%)": (0.667, 0.5),
    "BBB": (0.962, 0.8),
    "Pgp-inhibitor": (0.838, 0.8),
    "Pgp-substrate": (0.84, 0.8),
    "CYP1A2-Inhibitor": (0.867, 0.5),
    "CYP1A2-Substrate": (0.702, 0.5),
    "CYP3A4-Inhibitor": (0.829, 0.8),
    "CYP3A4-Substrate": (0.749, 0.8),
    "CYP2C19-Inhibitor": (0.819, 0.5),
    "CYP2C19-Substrate": (0.769, 0.5),
    "CYP2C9-Inhibitor": (0.83, 0.5),
    "CYP2C9-Substrate": (0.734, 0.5),
    "CYP2D6-Inhibitor": (0.795, 0.5),
    "CYP2D6-Substrate": (0.76, 0.5),
    "hERG": (0.848, 1),
    "H-HT": (0.681, 1),
    "Ames": (0.834, 1),
    "SkinSen": (0.731, 1),
}


def desirable_share(profile: DataFrame, endpoint: str) -> Column:
    """Aggregate: the share of reference rows in the endpoint's interval, or over one half for a class
    (under it for a harmful one); an empty share counts as 1e-4."""
    x = F.col(f"`{endpoint}`")
    if endpoint in DESIRABLE:
        low, high = DESIRABLE[endpoint]
        inside = (x > low if low is not None else F.lit(True)) & (x < high if high is not None else F.lit(True))
    else:
        inside = x > 0.5
    share = F.sum(F.coalesce(inside, F.lit(False)).cast("int")) / F.count("*")
    share = F.when(share == 0, 1e-4).otherwise(share)
    return 1 - share if endpoint in HARMFUL else share


def endpoint_weights(profile: DataFrame, endpoints: list[str] | None = None) -> dict[str, float]:
    """Weight of each endpoint: (0.75 share + 0.25) x quality x importance, from one aggregate row."""
    names = list(endpoints or ENDPOINTS)
    row = profile.agg(*[desirable_share(profile, e).alias(f"s{i}") for i, e in enumerate(names)]).first()
    known = [q for q, _ in ENDPOINTS.values() if q is not None]
    quality = {e: q if q is not None else sum(known) / len(known) for e, (q, _) in ENDPOINTS.items()}
    return {e: (0.75 * row[i] + 0.25) * quality[e] * ENDPOINTS[e][1] for i, e in enumerate(names)}


def desirability(endpoint: str, log_ld50: bool = True) -> Column:
    """Between 0 and 1: the curve for a measured endpoint, the probability (or its complement) for a class."""
    x = F.col(f"`{endpoint}`").cast("double")
    if endpoint in CURVES:
        x = F.when(x > 0, F.log10(x)) if endpoint == "LD50" and log_ld50 else x
        return CURVES[endpoint].of(x)
    p = 1 - x if endpoint in HARMFUL else x
    return F.when(p == 0, 1e-5).otherwise(p)


def weighted_geomean(terms: Mapping[str, Column], weights: Mapping[str, float]) -> Column:
    """exp(sum w ln d / sum w); null where a term is missing or not positive."""
    total = sum(weights[k] for k in terms)
    logs = [F.when(d > 0, F.log(d)) * float(weights[k]) for k, d in terms.items()]
    return F.exp(reduce(lambda a, b: a + b, logs) / total)


def admet_score(endpoints: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    """(name, score): the weighted geometric mean of the desirabilities."""
    return endpoints.select("name", weighted_geomean({e: desirability(e) for e in weights}, weights).alias("score"))


def lethal_dose(y: Column, weight: Column) -> Column:
    """mg/kg from -log10(mol/kg)."""
    return F.pow(F.lit(10.0), -y) * weight * 1000


@dataclass(frozen=True)
class Term:
    """A term of the composite: how missing values are filled, and whether more is better."""

    column: str
    weight: float
    ascending: bool = True
    fill: float | str | None = None


# The default weights of the composite score.
DEFAULT_TERMS = (
    Term("dock_score", 1.0, ascending=False),
    Term("key_residue_hbonds", 0.5, fill=0.0),
    Term("admet_score", 0.5, fill="median"),
    Term("dln_count", 0.3, fill=0.0),
)


def composite(df: DataFrame, terms: tuple[Term, ...] = DEFAULT_TERMS, places: int = 6) -> DataFrame:
    """Add composite_score: the weighted mean of the scaled terms. A term counts if its column has any value.

    The exact medians of some columns are found first; then two aggregate passes give one row each: counts, and the
    extremes of the filled columns.
    """
    present = [t for t in terms if t.column in df.columns]
    middle = quantiles.medians(df, [t.column for t in present if t.fill == "median"]) if any(t.fill == "median" for t in present) else {}
    stats = df.agg(*[F.count(t.column).alias(f"_n_{t.column}") for t in present], *[F.lit(v).cast("double").alias(f"_m_{c}") for c, v in middle.items()])
    df = df.crossJoin(F.broadcast(stats))
    for t in present:
        if t.fill is not None:
            value = F.col(f"_m_{t.column}") if t.fill == "median" else F.lit(float(t.fill))
            df = df.withColumn(f"_f_{t.column}", F.coalesce(F.col(t.column).cast("double"), value))
        else:
            df = df.withColumn(f"_f_{t.column}", F.col(t.column).cast("double"))
    df = with_extremes(df, *[f"_f_{t.column}" for t in present])
    used = lambda t: F.when(F.col(f"_n_{t.column}") > 0, t.weight).otherwise(0.0)
    scaled = lambda t: F.coalesce(min_max(F.col(f"_f_{t.column}"), F.col(f"_lo__f_{t.column}"), F.col(f"_hi__f_{t.column}"), t.ascending), F.lit(0.0))
    total = reduce(lambda a, b: a + b, [used(t) for t in present])
    score = reduce(lambda a, b: a + b, [used(t) * scaled(t) for t in present]) / total
    out = df.withColumn("composite_score", F.round(score, places))
    return out.drop(*[c for c in out.columns if c.startswith(("_n_", "_m_", "_f_", "_lo_", "_hi_"))])


def ranked(df: DataFrame, score: str = "composite_score") -> DataFrame:
    """Add rank: one plus the number of rows with a higher score."""
    return ordering.ranked(df, score)


def ranked_composite(df: DataFrame, terms: tuple[Term, ...] = DEFAULT_TERMS, places: int = 6) -> DataFrame:
    """Composite score and rank. The rows are looked at four times (medians, extremes, distinct scores, themselves), so
    what their joins give is written once, and once more with the scores."""
    return ranked(checkpointed(composite(checkpointed(df), terms, places)))


def top_n(df: DataFrame, n: int, key: str, rank: str = "rank") -> DataFrame:
    """The first n rows by rank; ties go by key."""
    return df.orderBy(rank, key).limit(n)


def summary(df: DataFrame, score: str, hbonds: str) -> DataFrame:
    """One row: count, spread of the score, its exact median, and the share with a key hydrogen bond."""
    middle = quantiles.medians(df, [score])[score]
    return df.agg(
        F.count("*").alias("n"),
        F.min(score).alias("min_score"),
        F.round(F.sum(F.col(score).cast("decimal(18,6)")).cast("double") / F.count(score), 6).alias("mean_score"),
        F.round(F.lit(middle).cast("double"), 6).alias("median_score"),
        F.max(score).alias("max_score"),
        F.round(F.count_if(F.col(hbonds) >= 1) / F.count("*"), 6).alias("hbond_share"),
    )


def means(df: DataFrame, columns: Sequence[str], top: Sequence[int] = (), rank: str = "rank", key: str = "name") -> DataFrame:
    """(rows, n, mean_c ...): means of the columns over all rows, and over the first rows by rank (ties by key)."""
    exact = lambda c: (F.sum(F.col(c).cast("decimal(24,6)")).cast("double") / F.count(c)).alias(f"mean_{c}")
    parts = [df.agg(F.lit("all").alias("rows"), F.count("*").alias("n"), *map(exact, columns))]
    parts += [top_n(df, n, key, rank).agg(F.lit(f"top {n}").alias("rows"), F.count("*").alias("n"), *map(exact, columns)) for n in top]
    return reduce(DataFrame.unionByName, parts)
