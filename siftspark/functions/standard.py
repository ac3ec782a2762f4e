"""Standardisation of molecules: named steps that run in order, one pass over each row."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.functions import molecules as m
from siftspark.session import find_package


def _single(mol: m.Mol) -> m.Mol | None:
    """One of several equal fragments; None for a mixture of different ones."""
    parts = {m.write(p): p for p in (mol.part(f) for f in mol.fragments())}
    return next(iter(parts.values())) if len(parts) == 1 else None


#: name -> function of a molecule, which gives the next molecule or None to drop the row.
STEPS: dict[str, Callable[[m.Mol], m.Mol | None]] = {
    "cleanup": lambda mol: m.parse(m.write(mol)),
    "remove_isotopes": m.without_isotopes,
    "remove_salts": m.without_salts,
    "largest_fragment": m.largest_fragment,
    "neutralise": m.neutral,
    "remove_inorganic": lambda mol: mol if m.organic(mol) else None,
    "remove_inorganic_fragments": m.organic_part,
    "remove_mixtures": _single,
    "weight_1000": lambda mol: mol if m.weight(mol) <= 1000 else None,
    "atoms_6": lambda mol: mol if len(mol.atoms) + sum(mol.hydrogens) >= 6 else None,
    "validate": lambda mol: m.molecule(m.write(mol)),
}
DEFAULT = ("cleanup", "remove_isotopes", "remove_salts", "largest_fragment", "neutralise", "remove_inorganic", "validate")


def run_steps(smiles: str | None, steps: Sequence[str]) -> tuple[str | None, str | None]:
    """(canonical text, None), or (None, the step that dropped it)."""
    mol = m.molecule(smiles)
    if mol is None:
        return None, "parse"
    for name in steps:
        try:
            mol = STEPS[name](mol)
        except (ValueError, RecursionError):
            mol = None
        if mol is None:
            return None, name
    return m.write(mol), None


def _column(steps: Sequence[str]):  # noqa: ANN202
    unknown = [s for s in steps if s not in STEPS]
    if unknown:
        raise KeyError(f"no step {unknown[0]}; there are {', '.join(STEPS)}")
    find_package(SparkSession.active())
    names = tuple(steps)

    @F.pandas_udf("smiles string, dropped_at string")
    def run(values: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([run_steps(s, names) for s in values], columns=["smiles", "dropped_at"], dtype=object)

    return run


def standardised(df: DataFrame, steps: Sequence[str] = DEFAULT, column: str = "smiles") -> DataFrame:
    """All rows, with the text after all steps (null where one dropped it) and ``dropped_at``, the name of that step."""
    rows = df.withColumn("_s", _column(steps)(F.col(column)))
    return rows.withColumn(column, F.col("_s.smiles")).withColumn("dropped_at", F.col("_s.dropped_at")).drop("_s")


def standard_pairs(df: DataFrame, steps: Sequence[str] = DEFAULT, a: str = "a", b: str = "b") -> DataFrame:
    """Pairs of structs (name, smiles) of which both members pass all steps, with their new texts."""
    run = _column(steps)
    rows = df.withColumn("_a", run(F.col(f"{a}.smiles"))).withColumn("_b", run(F.col(f"{b}.smiles"))).filter("_a.smiles IS NOT NULL AND _b.smiles IS NOT NULL")
    return rows.withColumns({side: F.col(side).withField("smiles", F.col(f"_{k}.smiles")) for k, side in (("a", a), ("b", b))}).drop("_a", "_b")


def step_report(rows: DataFrame, steps: Sequence[str] = DEFAULT) -> DataFrame:
    """(place, step, dropped, left) of standardised rows, parsing first: how many rows each step dropped and how many went on."""
    spark = rows.sparkSession
    names = spark.createDataFrame(list(enumerate(("parse", *steps))), "place int, step string")
    counts = rows.groupBy(F.col("dropped_at").alias("step")).agg(F.count("*").alias("dropped"))
    total = rows.agg(F.count("*").alias("_all"))
    every = names.join(counts, "step", "left").na.fill(0, ["dropped"]).crossJoin(total)
    # A handful of steps.
    earlier = spark.createDataFrame([(i, j) for i in range(len(steps) + 1) for j in range(i + 1)], "place int, before int")
    gone = earlier.join(every.select(F.col("place").alias("before"), F.col("dropped").alias("_d")), "before").groupBy("place").agg(F.sum("_d").alias("_gone"))
    return every.join(gone, "place").select("place", "step", "dropped", (F.col("_all") - F.col("_gone")).alias("left"))
