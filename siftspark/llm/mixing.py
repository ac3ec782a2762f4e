"""Mixing sources to target weights (DataFrame and SQL functions only).

Documents fall into cells of source x language x topic. Iterative proportional
fitting rakes the cells' token counts until the source, language and topic
marginals meet their targets; each document is then taken with the calibrated
rate of its cell. The targets name their categories, all others share the
category ``*``, so there are at most as many cells as the targets allow,
however many sources the data have. Fitting runs in one row over that bounded
table; each text is looked at once, and its cell and token count are written.

Defined results: null text has no tokens; a null or unlisted category counts as
``*``; a category without tokens hands its share to the others; with no tokens
at all every rate is zero. A rate above one repeats a document: ``copies`` is
the whole part plus one with the chance of the rest, and the sample has so many rows of it. The draw depends on the
seed and doc_id alone, so repeated rows are drawn alike; a null doc_id draws
as the empty text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REST = "*"


@dataclass(frozen=True)
class Mix:
    """Target shares of tokens by category, and the size of the sample.

    ``budget``: tokens to take, as a share of all tokens. ``rounds``: raking
    rounds of one update per marginal each.
    """

    source: dict[str, float]
    lang: dict[str, float]
    topic: dict[str, float]
    budget: float = 0.5
    rounds: int = 50
    seed: str = "mix"

    def axes(self) -> list[tuple[str, list[str], list[float]]]:
        return [(name, [*(k for k in t if k != REST), REST], [*(v for k, v in t.items() if k != REST), t.get(REST, 0.0)]) for name, t in (("source", self.source), ("lang", self.lang), ("topic", self.topic))]

    def n_cells(self) -> int:
        n = 1
        for _, keys, _ in self.axes():
            n *= len(keys)
        return n


#: The mix of the registered query and of the pipeline.
PRODUCTION = Mix(
    source={f"src{i}": 0.045 for i in range(20)} | {REST: 0.1},
    lang={"en": 0.5, "de": 0.2, "fr": 0.15, "es": 0.1, REST: 0.05},
    topic={"table": 0.02, "notice": 0.04, "contact": 0.06, "brief": 0.03, REST: 0.85},
)


def topic_of(text: Column) -> Column:
    """A coarse topic from marks in the whole text; prose has none and is ``*``."""
    return (
        F.when(text.contains(" | "), "table")
        .when(F.lower(text).rlike("licen[sc]e|copyright"), "notice")
        .when(text.rlike("@[A-Za-z0-9.-]+\\.[a-z]|\\(\\d{3}\\) \\d{3}-\\d{4}"), "contact")
        .when(F.length(text) < 500, "brief")
        .otherwise(REST)
    )


def _index(value: Column, keys: list[str]) -> Column:
    """Place of the category among the keys, counted from 0; the last is the rest."""
    found = F.coalesce(F.array_position(F.array(*map(F.lit, keys[:-1])), value), F.lit(0)) if len(keys) > 1 else F.lit(0)
    return F.when(found > 0, found - 1).otherwise(F.lit(len(keys) - 1)).cast("int")


def _traits(mix: Mix, row: str = "") -> list[Column]:
    text = F.coalesce(F.col(f"{row}text"), F.lit(""))
    values = {"source": F.col(f"{row}source"), "lang": F.col(f"{row}lang"), "topic": topic_of(text)}
    place: Column = F.lit(0)
    for name, keys, _ in mix.axes():
        place = place * len(keys) + _index(values[name], keys)
    return [values["topic"].alias("_topic"), F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("_tokens"), place.cast("int").alias("_cell")]


def cell_rates(cells: DataFrame, mix: Mix) -> DataFrame:
    """(_cell, _weight, _rate) for each cell of the mix, from (_cell, _n) token counts.

    The fitted share of a cell is its token share times one factor for each of
    its three categories. The factors are found in turn: each is its target
    over the sum that the other factors leave for it.
    """
    (_, _, ts), (_, _, tl), (_, _, tt) = axes = mix.axes()
    a, b, c = (len(keys) for _, keys, _ in axes)
    seq = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    one = cells.agg(F.map_from_entries(F.collect_list(F.struct("_cell", F.col("_n").cast("double")))).alias("_m"))
    one = one.select(F.transform(seq(a * b * c), lambda i: F.coalesce(F.element_at("_m", i), F.lit(0.0))).alias("_seed"))
    one = one.select("_seed", F.aggregate("_seed", F.lit(0.0), lambda x, y: x + y).alias("_total"))
    at = lambda s, l, t: F.get("_seed", (s * b + l) * c + t)  # noqa: E731, E741

    def total(n: int, term) -> Column:  # noqa: ANN001
        return F.aggregate(seq(n), F.lit(0.0), lambda acc, j: acc + term(j))

    def share(targets: list[float], n: int, mass) -> Column:  # noqa: ANN001
        """Targets of the categories that have tokens, scaled to one."""
        present = F.transform(seq(n), lambda i: F.when(mass(i) > 0, F.get(F.array(*map(F.lit, targets)), i)).otherwise(F.lit(0.0)))
        return F.element_at(F.transform(F.array(present), lambda p: F.transform(p, lambda x: F.coalesce(F.try_divide(x, F.aggregate(p, F.lit(0.0), lambda u, v: u + v)), F.lit(0.0)))), 1)

    one = one.select(
        "_seed",
        "_total",
        share(ts, a, lambda s: total(b * c, lambda j: at(s, F.floor(j / c).cast("int"), j % c))).alias("_ts"),
        share(tl, b, lambda l: total(a * c, lambda j: at(F.floor(j / c).cast("int"), l, j % c))).alias("_tl"),  # noqa: E741
        share(tt, c, lambda t: total(a * b, lambda j: at(F.floor(j / b).cast("int"), j % b, t))).alias("_tt"),
    )
    ones = lambda n: F.array_repeat(F.lit(1.0), n)
    start = F.struct(ones(a).alias("s"), ones(b).alias("l"), ones(c).alias("t"))

    def fitted(targets: str, n: int, mass) -> Column:  # noqa: ANN001
        return F.transform(seq(n), lambda i: F.coalesce(F.try_divide(F.get(targets, i), mass(i)), F.lit(0.0)))

    def update(f: Column, k: Column) -> Column:
        s = fitted("_ts", a, lambda i: total(b * c, lambda j: at(i, F.floor(j / c).cast("int"), j % c) * F.get(f["l"], F.floor(j / c).cast("int")) * F.get(f["t"], j % c)))
        l = fitted("_tl", b, lambda i: total(a * c, lambda j: at(F.floor(j / c).cast("int"), i, j % c) * F.get(f["s"], F.floor(j / c).cast("int")) * F.get(f["t"], j % c)))  # noqa: E741
        t = fitted("_tt", c, lambda i: total(a * b, lambda j: at(F.floor(j / b).cast("int"), j % b, i) * F.get(f["s"], F.floor(j / b).cast("int")) * F.get(f["l"], j % b)))
        return F.struct(F.when(k == 0, s).otherwise(f["s"]).alias("s"), F.when(k == 1, l).otherwise(f["l"]).alias("l"), F.when(k == 2, t).otherwise(f["t"]).alias("t"))

    one = one.withColumn("_f", F.aggregate(F.sequence(F.lit(0), F.lit(3 * mix.rounds - 1)), start, lambda f, i: update(f, i % 3)))
    weight = F.col("_n") * F.get("_f.s", F.floor(F.col("_cell") / (b * c)).cast("int")) * F.get("_f.l", F.floor(F.col("_cell") / c).cast("int") % b) * F.get("_f.t", F.col("_cell") % c)
    rows = one.select("_f", "_total", F.posexplode("_seed").alias("_cell", "_n"))
    rows = rows.select("_cell", "_n", "_total", weight.alias("_weight"))
    return rows.select("_cell", "_weight", F.coalesce(F.try_divide(F.lit(mix.budget) * F.col("_total") * F.col("_weight"), F.col("_n")), F.lit(0.0)).alias("_rate"))


def _copies(doc_id: Column, mix: Mix) -> Column:
    digest = F.md5(F.concat(F.lit(mix.seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    draw = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(2**52))
    return (F.floor("_rate") + F.when(draw < F.col("_rate") - F.floor("_rate"), 1).otherwise(0)).cast("int")


def _counted(traits: DataFrame) -> DataFrame:
    return traits.groupBy("_cell").agg(F.sum("_tokens").alias("_n"))


def mix_documents(docs: DataFrame, mix: Mix = PRODUCTION) -> DataFrame:
    """One row per document: its cell, the cell's fitted share, the rate, and how often it is taken."""
    from siftspark.session import checkpointed

    traits = checkpointed(docs.select("doc_id", "source", "lang", *_traits(mix)))
    return traits.join(F.broadcast(cell_rates(_counted(traits), mix)), "_cell").select(
        "doc_id",
        "source",
        "lang",
        F.col("_topic").alias("topic"),
        F.col("_tokens").alias("n_tokens"),
        F.round("_weight", 6).alias("cell_share"),
        F.round("_rate", 6).alias("rate"),
        _copies(F.col("doc_id"), mix).alias("copies"),
    )


def fitted_marginals(docs: DataFrame, mix: Mix = PRODUCTION) -> DataFrame:
    """(axis, category, target, fitted): the share of tokens that raking reached for each category. Where a target
    cannot be met, as all its cells are empty or the targets contradict each other, the two differ."""
    weights = cell_rates(_counted(docs.select(*_traits(mix))), mix)
    size, parts = mix.n_cells(), []
    for name, keys, targets in mix.axes():
        size //= len(keys)
        place = (F.floor(F.col("_cell") / size) % len(keys)).cast("int")
        values = [F.get(F.array(*map(F.lit, v)), F.col("_k")) for v in (keys, targets)]
        sums = weights.groupBy(place.alias("_k")).agg(F.sum("_weight").alias("fitted"))
        parts.append(sums.select(F.lit(name).alias("axis"), values[0].alias("category"), values[1].alias("target"), "fitted"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def sample_documents(docs: DataFrame, mix: Mix = PRODUCTION) -> DataFrame:
    """The documents taken, each as often as its rate says, with all their columns plus ``mix_rate`` and ``mix_copies``.

    Names that the input already has are replaced.
    """
    from siftspark.session import checkpointed

    rows = checkpointed(docs.select(F.struct("*").alias("_row")).select("_row", *_traits(mix, "_row.")))
    taken = rows.join(F.broadcast(cell_rates(_counted(rows), mix)), "_cell").withColumn("_copies", _copies(F.col("_row.doc_id"), mix)).filter("_copies > 0")
    kept = [F.col("_row")[c].alias(c) for c in docs.columns if c not in ("mix_rate", "mix_copies")]
    every = taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return every.select(*kept, F.round("_rate", 6).alias("mix_rate"), F.col("_copies").alias("mix_copies"))
