"""The screening funnel as one lazy plan: each module narrows the library, the last ranks what is left."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.operators import dedup, filters, joins, scoring
from siftspark.plans.config import Config


@dataclass(frozen=True)
class Screening:
    """Inputs by name, all keyed by ``name``; an input that is None skips its module or term."""

    config: Config
    library: DataFrame
    physchem: DataFrame | None = None
    endpoints: DataFrame | None = None
    predictions: DataFrame | None = None
    dock_scores: DataFrame | None = None
    hbonds: DataFrame | None = None

    def _kept(self, module: str, table: DataFrame | None, keep) -> Screening:  # noqa: ANN001
        if table is None or not self.config.runs(module):
            return self
        return replace(self, library=joins.keep_selected(self.library, keep(table)))

    def prepared(self) -> Screening:
        """Single-component rows, the first of each name."""
        if not self.config.runs("library"):
            return self
        single = self.library.filter(filters.single_component(F.col("smiles")))
        return replace(self, library=dedup.first_wins(single, ["name"], F.col("row_id")) if "row_id" in single.columns else single)

    def by_physchem(self) -> Screening:
        return self._kept("physchem", self.physchem, lambda t: filters.property_vote(t, self.config.physchem, self.config.physchem_least))

    def by_endpoints(self) -> Screening:
        return self._kept("admet", self.endpoints, lambda t: filters.all_within(t, self.config.admet))

    def by_votes(self) -> Screening:
        return self._kept("druglikeness", self.predictions, lambda t: filters.vote_filter(t, self.config.models, self.config.votes_least))

    def by_hbonds(self) -> Screening:
        return self._kept("docking", self.hbonds, filters.with_key_bonds)

    def funnel(self) -> list[tuple[str, Screening]]:
        """The state after each module, all in one plan; nothing has run yet."""
        states, state = [("library", self.prepared())], self.prepared()
        for name, step in (("physchem", Screening.by_physchem), ("admet", Screening.by_endpoints), ("druglikeness", Screening.by_votes), ("docking", Screening.by_hbonds)):
            state = step(state)
            states.append((name, state))
        return states

    def results(self) -> DataFrame:
        """Ranked rows of the narrowed library."""
        state = self.funnel()[-1][1]
        if state.dock_scores is None:
            raise ValueError("docking scores are needed to rank")
        base = joins.keep_selected(filters.numeric(state.dock_scores, "dock_score"), state.library)
        admet = None if state.endpoints is None else state.endpoints.select("name", F.col("score").alias("admet_score"))
        dln = None if state.predictions is None else state.predictions.select("name", filters.votes(self.config.models).alias("dln_count"))
        joined = joins.left_join_all(base, [state.hbonds, state.physchem, admet, dln], "name")
        return scoring.ranked_composite(joined)


def funnel_counts(spark: SparkSession, states: list[tuple[str, Screening]]) -> DataFrame:
    """(step, module, n): rows left after each module, as one query."""
    counts = [s.library.agg(F.count("*").alias("n")).select(F.lit(i).alias("step"), F.lit(m).alias("module"), "n") for i, (m, s) in enumerate(states)]
    out = counts[0]
    for c in counts[1:]:
        out = out.union(c)
    return out
