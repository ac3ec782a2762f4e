"""Per-molecule kernels behind one registry.

A kernel is a pandas UDF over SMILES. Where RDKit is installed its kernels are used for canonical text, weights and
keys; else, and for all others, those of :mod:`siftspark.functions.molecules`, whose values are not all RDKit's.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftspark.functions import molecules as m
from siftspark.session import find_package

try:
    from rdkit import Chem
    from rdkit.Chem import Descriptors, inchi
except ImportError:
    Chem = None


def of_molecule(f: Callable) -> Callable:
    """A function of a SMILES text from one of a molecule; None where there is none."""

    def run(smiles: str):  # noqa: ANN202
        mol = m.molecule(smiles)
        return None if mol is None else f(mol)

    return run


def _canonical(s: str) -> str | None:
    if Chem is not None:
        mol = Chem.MolFromSmiles(s)
        return None if mol is None else Chem.MolToSmiles(mol)
    return m.canonical(s)


def _weight(s: str) -> float | None:
    if Chem is not None:
        mol = Chem.MolFromSmiles(s)
        return None if mol is None else Descriptors.MolWt(mol)
    return of_molecule(m.weight)(s)


def _key(s: str) -> str | None:
    if Chem is not None:
        mol = Chem.MolFromSmiles(s)
        return None if mol is None else inchi.MolToInchiKey(mol)
    return m.structure_key(s)


def fingerprint(kind: str) -> Callable:
    """On-bits by kind: ``keys`` (yes-or-no patterns), or ``ecfpD_N`` of diameter D hashed to N bits, such as ecfp4_1024."""
    if kind == "keys":
        return of_molecule(m.keys)
    name, _, bits = kind.partition("_")
    if not name.startswith("ecfp") or not name[4:].isdigit() or not bits.isdigit():
        raise ValueError(f"unknown fingerprint {kind}")
    return of_molecule(lambda mol: m.hashed_bits(mol, int(name[4:]) // 2, int(bits)))


#: name -> (function of one SMILES, SQL type).
_KERNELS: dict[str, tuple[Callable, str]] = {
    "canonical": (_canonical, "string"),
    "heavy_atoms": (of_molecule(lambda mol: float(sum(a.symbol != "H" for a in mol.atoms))), "double"),
    "all_atoms": (of_molecule(lambda mol: float(len(mol.atoms) + sum(mol.hydrogens))), "double"),
    "rings": (of_molecule(lambda mol: float(len(mol.rings()))), "double"),
    "acceptors": (of_molecule(lambda mol: float(m.acceptors(mol))), "double"),
    "weight": (_weight, "double"),
    "physchem": (of_molecule(m.properties), "map<string,double>"),
    "descriptors": (of_molecule(m.descriptors), "map<string,double>"),
    "organic": (of_molecule(m.organic), "boolean"),
    "largest_fragment": (of_molecule(lambda mol: m.write(m.largest_fragment(mol))), "string"),
    "scaffold": (m.scaffold, "string"),
    "key": (_key, "string"),
    "fingerprint": (fingerprint("ecfp4_1024"), "array<int>"),
    "keys": (fingerprint("keys"), "array<int>"),
    "counted_environments": (of_molecule(lambda mol: dict(m.environments(mol, 2))), "map<bigint,int>"),
}


class KernelRegistry:
    """Kernels by name; register your own to add a model or a descriptor set."""

    def __init__(self) -> None:
        self._kernels = dict(_KERNELS)

    def register(self, name: str, kernel: Callable, sql_type: str) -> None:
        self._kernels[name] = (kernel, sql_type)

    def names(self) -> list[str]:
        return sorted(self._kernels)

    def apply(self, name: str, smiles: Column) -> Column:
        """The kernel's value; null for null input and where it fails."""
        if name not in self._kernels:
            raise KeyError(f"no kernel {name}; there are {', '.join(self.names())}")
        return per_value(*self._kernels[name])(smiles)


def per_value(kernel: Callable, sql_type: str) -> Callable[[Column], Column]:
    """A pandas UDF of one text column; null where the function fails."""
    from pyspark.sql import SparkSession

    find_package(SparkSession.active())

    def guarded(s: str | None):  # noqa: ANN202
        try:
            return None if s is None else kernel(s)
        except (ValueError, KeyError, IndexError, TypeError, RecursionError):
            return None

    @F.pandas_udf(sql_type)
    def run(values: pd.Series) -> pd.Series:
        return pd.Series([guarded(s) for s in values], dtype=object)

    return run


def substructures(df: DataFrame, column: str, patterns: Sequence[str]) -> DataFrame:
    """Add m0, m1, ...: whether each pattern is part of the molecule, 1 or 0, null where the text is none; and any_match."""
    wanted = list(patterns)
    found = per_value(of_molecule(lambda mol: [int(m.matches(mol, m.pattern(p))) for p in wanted]), "array<int>")
    rows = df.withColumn("_m", found(F.col(column)))
    return rows.select(*df.columns, *[F.get("_m", F.lit(i)).alias(f"m{i}") for i in range(len(wanted))], F.coalesce(F.array_contains("_m", 1), F.lit(False)).alias("any_match"))


def with_conformers(df: DataFrame, n: int, smiles: str = "smiles", name: str = "name", generate: Callable | None = None) -> DataFrame:
    """(name, conf_id, file_name, atom, element, x, y, z): a row for each atom of each conformer; molecules that fail have none.

    ``generate``: a function (smiles, n) -> conformers, each a list of (element, x, y, z); the default is a crude stand-in that takes
    the molecules of a batch together.
    """
    find_package(df.sparkSession)

    def each(texts):  # noqa: ANN001, ANN202
        for s in texts:
            try:
                yield list(generate(s, n)) if s is not None else []
            except (ValueError, RuntimeError):
                yield []

    def run(batches):  # noqa: ANN001, ANN202
        for batch in batches:
            rows = []
            for key, made in zip(batch[name], each(batch[smiles]) if generate else m.conformers_of(batch[smiles], n), strict=True):
                rows += [(key, k, f"{key}_conf_{k}", i, *atom) for k, atoms in enumerate(made) for i, atom in enumerate(atoms)]
            yield pd.DataFrame(rows, columns=["name", "conf_id", "file_name", "atom", "element", "x", "y", "z"])

    return df.select(name, smiles).mapInPandas(run, "name string, conf_id int, file_name string, atom int, element string, x double, y double, z double")
