"""Atoms, poses, boxes and contacts."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftspark.operators.spatial import within


def bounding_box(atoms: DataFrame, by: Sequence[str] = (), extend: float = 0.0, least: float = 0.0) -> DataFrame:
    """Centre and size along each axis: the middle of the extremes, the range plus ``extend`` but at least ``least``."""
    axes = ("x", "y", "z")
    row = atoms.groupBy(*by).agg(*[f(a).alias(f"{p}{a}") for a in axes for p, f in (("lo_", F.min), ("hi_", F.max))])
    centre = [F.round((F.col(f"hi_{a}") + F.col(f"lo_{a}")) / 2, 4).alias(f"center_{a}") for a in axes]
    size = [F.round(F.greatest(F.col(f"hi_{a}") - F.col(f"lo_{a}") + extend, F.lit(least)), 4).alias(f"size_{a}") for a in axes]
    return row.select(*by, *centre, *size)


def pocket_box(atoms: DataFrame, first: int, last: int, margin: float) -> DataFrame:
    """Mean position of the residues first..last, and their range plus a margin."""
    inside = atoms.filter(F.col("resnum").between(first, last))
    mean = lambda a: (F.sum(F.col(a).cast("decimal(20,6)")).cast("double") / F.count(a))
    return inside.agg(*[F.round(mean(a), 4).alias(f"center_{a}") for a in "xyz"], *[F.round(F.max(a) - F.min(a) + margin, 4).alias(f"size_{a}") for a in "xyz"])


def residues(atoms: DataFrame) -> DataFrame:
    """(chain, resnum, resname): number of atoms, and whether one is carbon."""
    return atoms.groupBy("chain", "resnum", "resname").agg(F.count("*").alias("n_atoms"), F.bool_or(F.col("element") == "C").alias("has_carbon"))


def ligands(atoms: DataFrame, header: DataFrame) -> DataFrame:
    """Hetero residues with carbon that are neither water nor part of the sequence, with their atoms counted."""
    hetero = residues(atoms.filter(selection("hetero and not water")))
    sequence = header.filter(F.col("rec").isin("SEQRES", "MODRES")).select("resname").distinct()
    return hetero.filter("has_carbon").join(sequence, "resname", "left_anti")


def largest_ligand(found: DataFrame, suffix: str | None = None) -> DataFrame:
    """The ligand with most atoms (the first in order wins ties), or the first whose name ends so."""
    order = ["chain", "resnum", "resname"]
    named = found.filter(F.endswith("resname", F.lit(suffix))) if suffix else found
    return named.orderBy(*([] if suffix else [F.desc("n_atoms")]), *order).limit(1)


def is_protein(resname: Column) -> Column:
    # The twenty standard residues.
    return resname.isin(*"ALA ARG ASN ASP CYS GLN GLU GLY HIS ILE LEU LYS MET PHE PRO SER THR TRP TYR VAL".split())


# Names of nucleotides and of water.
NUCLEOTIDES = "A C G U I DA DC DG DT DU DI".split()
NUCLEOSIDES = "A C G U DA DC DG DT AMP ADP ATP CMP CDP CTP GMP GDP GTP UMP UDP UTP TMP TDP TTP".split()
WATERS = ("HOH", "WAT", "DOD")


def selection(text: str) -> Column:
    """A condition on atoms from a few words: protein, water, nucleotide, nucleoside, hetero, ``chain A B``, ``resnum 5 to 9`` or
    ``resnum 5 7``, ``resname X Y``, ``element C``, joined by and, or, not and parentheses."""
    words = re.findall(r"[()]|[^\s()]+", text)
    kinds = {
        "protein": is_protein(F.col("resname")), "water": F.col("resname").isin(*WATERS), "nucleotide": F.col("resname").isin(*NUCLEOTIDES),
        "nucleoside": F.col("resname").isin(*NUCLEOSIDES), "hetero": F.col("hetero"), "all": F.lit(True),
    }
    at = 0

    def either() -> Column:
        nonlocal at
        left = both()
        while at < len(words) and words[at] == "or":
            at += 1
            left = left | both()
        return left

    def both() -> Column:
        nonlocal at
        left = one()
        while at < len(words) and words[at] == "and":
            at += 1
            left = left & one()
        return left

    def one() -> Column:
        nonlocal at
        if at == len(words):
            raise ValueError(f"{text!r} ends early")
        word = words[at]
        at += 1
        if word == "not":
            return ~one()
        if word == "(":
            inner = either()
            if at == len(words) or words[at] != ")":
                raise ValueError(f"missing ) in {text!r}")
            at += 1
            return inner
        if word in kinds:
            return kinds[word]
        if word not in ("chain", "resnum", "resname", "element"):
            raise ValueError(f"unknown word {word!r} in {text!r}")
        values = []
        while at < len(words) and words[at] not in ("and", "or", ")"):
            values.append(words[at])
            at += 1
        if word == "resnum" and len(values) == 3 and values[1] == "to":
            return F.col(word).between(int(values[0]), int(values[2]))
        return F.col(word).isin(*(map(int, values) if word == "resnum" else values))

    found = either()
    if at < len(words):
        raise ValueError(f"{words[at]!r} is left over in {text!r}")
    return found


def cleaned_receptor(atoms: DataFrame) -> DataFrame:
    """The protein's atoms."""
    return atoms.filter(selection("protein"))


def angles(triples: DataFrame) -> DataFrame:
    """Add angle, in degrees at the middle point, to triples of points (ax ay az, bx by bz, cx cy cz)."""
    dot = lambda p, q: sum((F.col(f"{p}{c}") - F.col(f"b{c}")) * (F.col(f"{q}{c}") - F.col(f"b{c}")) for c in "xyz")
    cosine = F.try_divide(dot("a", "c"), F.sqrt(dot("a", "a") * dot("c", "c")))
    return triples.withColumn("angle", F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))))


def hydrogen_bonds(donors: DataFrame, acceptors: DataFrame, cutoff: float = 3.5, least_angle: float = 0.0) -> DataFrame:
    """(d, a, distance, angle) of donors (id, x, y, z, and the place bx, by, bz of the atom that holds the hydrogen's place) with acceptors
    within the cutoff, whose angle at the donor's partner is large enough; a null partner passes."""
    found = contacts(donors, acceptors, cutoff)
    place = lambda df, name, p, c: df.select(F.col("id").alias(name), *[F.col(x).alias(f"{p}{y}") for x, y in zip(c, "xyz", strict=True)])
    triples = found.join(place(donors, "d", "a", ("x", "y", "z")), "d").join(place(donors, "d", "b", ("bx", "by", "bz")), "d").join(place(acceptors, "a", "c", ("x", "y", "z")), "a")
    return angles(triples).filter(F.coalesce(F.col("angle") >= least_angle, F.lit(True))).select("d", "a", "distance", "angle")


def contacts(donors: DataFrame, acceptors: DataFrame, cutoff: float) -> DataFrame:
    """(d, a, distance) of points (id, x, y, z) within the cutoff, in cells that follow the density."""
    return within(donors, acceptors, cutoff)


def unordered_pairs(df: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """Distinct pairs of each key, whichever way round they are listed."""
    return df.select(key, F.least(a, b).alias("_a"), F.greatest(a, b).alias("_b")).distinct().groupBy(key).agg(F.count("*").alias("n_pairs"))


def hbond_counts(pairs: DataFrame, atoms: DataFrame, key_residues: Sequence[int], chain: str | None = None) -> DataFrame:
    """(ligand_name, total_hbonds, key_residue_hbonds) from (ligand_name, atom_id) pairs and the receptor's atoms."""
    key = F.col("resnum").isin(*key_residues) & (F.lit(True) if chain is None else F.col("chain") == chain)
    return pairs.join(atoms.select("atom_id", "chain", "resnum"), "atom_id", "left").groupBy("ligand_name").agg(F.count("*").alias("total_hbonds"), F.count_if(key).alias("key_residue_hbonds"))
