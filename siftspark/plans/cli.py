"""Command line: ``python -m siftspark.plans.cli COMMAND --help``; each stage of a screening run, or all of them."""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from siftspark.functions.kernels import KernelRegistry, substructures
from siftspark.functions.standard import DEFAULT, standardised
from siftspark.operators import clustering, dedup, filters, sampling, scoring, similarity, structure
from siftspark.plans import config as settings
from siftspark.plans.screening import Screening
from siftspark.session import local_session
from siftspark.sources import reports, text

Options = argparse.Namespace


def screen(spark: SparkSession, o: Options) -> None:
    """run the funnel and write the ranked table and reports"""
    library, _ = text.parse_library(text.numbered_lines(spark, o.library))
    tables = {k: spark.read.parquet(getattr(o, k)) for k in ("physchem", "endpoints", "predictions", "dock_scores", "hbonds") if getattr(o, k)}
    config = settings.load(o.config)
    Screening(config, library, **tables).results().write.parquet(f"{o.out}/ranked")
    ranked = spark.read.parquet(f"{o.out}/ranked")
    top = scoring.top_n(ranked, config.top_n, "name")
    text.write_properties(top, f"{o.out}/top")
    page = spark.createDataFrame([(reports.html_report("Ranked compounds", top),)], "value string")
    page.coalesce(1).write.text(f"{o.out}/report")


def library(spark: SparkSession, o: Options) -> None:
    """keep single-component molecules, the first of each name, in standard form; write rejects beside them"""
    rows, bad = text.parse_library(text.numbered_lines(spark, o.library))
    done = standardised(dedup.first_wins(rows, ["name"], F.col("row_id")), o.steps.split(",") if o.steps else DEFAULT)
    text.write_library(done.filter("smiles IS NOT NULL"), f"{o.out}/library")
    text.append_rows(bad.unionByName(done.filter("smiles IS NULL").select("row_id", F.col("name").alias("value"))), f"{o.out}/rejects")


def properties(spark: SparkSession, o: Options) -> None:
    """work out the physico-chemical properties of a library"""
    rows, _ = text.parse_library(text.numbered_lines(spark, o.library))
    values = rows.withColumn("p", KernelRegistry().apply("physchem", F.col("smiles"))).filter("p IS NOT NULL")
    values.select("name", *[F.col("p")[c].alias(c) for c in filters.PROPERTY_SETS["all"]]).write.parquet(o.out)


def fingerprints(spark: SparkSession, o: Options) -> None:
    """write on-bits of a library as a table (id, bits)"""
    rows, _ = text.parse_library(text.numbered_lines(spark, o.library))
    rows.select(F.col("name").alias("id"), KernelRegistry().apply("fingerprint", F.col("smiles")).alias("bits")).filter("bits IS NOT NULL").write.parquet(o.out)


def substructure(spark: SparkSession, o: Options) -> None:
    """find the molecules that contain any of some patterns"""
    rows = text.titled_molecules(text.numbered_lines(spark, o.library))
    found = substructures(rows.withColumn("line", F.concat_ws(" ", "smiles", "id")), "smiles", o.pattern)
    text.write_matches(found.drop("any_match"), f"{o.out}/matrix", f"{o.out}/matches")


def pairs(spark: SparkSession, o: Options) -> None:
    """similar pairs of a table of on-bits"""
    similarity.threshold_pairs(spark.read.parquet(o.bits), o.threshold).write.parquet(o.out)


def cluster(spark: SparkSession, o: Options) -> None:
    """cluster a table of on-bits and write the report"""
    rows = spark.read.parquet(o.bits)
    found = clustering.butina(rows, similarity.threshold_pairs(rows, o.threshold))
    found.write.parquet(f"{o.out}/clusters")
    clustering.write_report(spark.read.parquet(f"{o.out}/clusters"), f"{o.out}/report")


def scores(spark: SparkSession, o: Options) -> None:
    """take the scores out of docked poses"""
    files = spark.read.option("wholetext", True).option("pathGlobFilter", f"*{o.suffix}").text(o.poses)
    good, bad = text.parse_pose_scores(files.select(F.col("_metadata.file_name").alias("file_name"), "value"), o.suffix)
    text.write_scores(good, f"{o.out}/scores")
    bad.write.parquet(f"{o.out}/rejects")


def split(spark: SparkSession, o: Options) -> None:
    """deal the names of a list to chunks"""
    text.write_chunks(spark.read.text(o.list).withColumnRenamed("value", "name"), "name", o.chunks, o.out)


def box(spark: SparkSession, o: Options) -> None:
    """write the docking box around the largest ligand, or around a selection of atoms"""
    lines = spark.read.text(o.structure)
    atoms = text.parse_atoms(lines)
    if o.select:
        chosen = atoms.filter(structure.selection(o.select))
    else:
        ligand = structure.largest_ligand(structure.ligands(atoms, text.parse_header(lines)))
        chosen = atoms.join(F.broadcast(ligand.select("chain", "resnum", "resname")), ["chain", "resnum", "resname"])
    text.box_lines(structure.bounding_box(chosen, extend=o.extend, least=o.least)).write.text(o.out)


def subset(spark: SparkSession, o: Options) -> None:
    """a random part of a table"""
    sampling.random_subset(spark.read.parquet(o.table), o.n, o.key, o.seed).write.parquet(o.out)


#: Command -> (function, options that are required, optional ones with their defaults).
COMMANDS: dict[str, tuple[Callable[[SparkSession, Options], None], tuple[str, ...], dict[str, object]]] = {
    "screen": (screen, ("config", "library", "out"), {"physchem": None, "endpoints": None, "predictions": None, "dock-scores": None, "hbonds": None}),
    "library": (library, ("library", "out"), {"steps": ""}),
    "properties": (properties, ("library", "out"), {}),
    "fingerprints": (fingerprints, ("library", "out"), {}),
    "substructure": (substructure, ("library", "out"), {"pattern": []}),
    "pairs": (pairs, ("bits", "out"), {"threshold": 0.8}),
    "cluster": (cluster, ("bits", "out"), {"threshold": 0.8}),
    "scores": (scores, ("poses", "out"), {"suffix": "_out.pdbqt"}),
    "split": (split, ("list", "out"), {"chunks": 4}),
    "box": (box, ("structure", "out"), {"select": "", "extend": 5.0, "least": 20.0}),
    "subset": (subset, ("table", "out"), {"n": 1000, "key": "id", "seed": 1}),
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="siftspark")
    parser.add_argument("--conf", default="{}", help="Spark settings as JSON")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, (run, required, optional) in COMMANDS.items():
        command = commands.add_parser(name, help=run.__doc__)
        for option in required:
            command.add_argument(f"--{option}", required=True)
        for option, default in optional.items():
            if isinstance(default, list):
                command.add_argument(f"--{option}", action="append", default=None)
            else:
                command.add_argument(f"--{option}", default=default, type=type(default) if default is not None else str)
    options = parser.parse_args(argv)
    COMMANDS[options.command][0](SparkSession.getActiveSession() or local_session(**json.loads(options.conf)), options)


if __name__ == "__main__":
    main()
