"""Readers of line formats, and writers. Bad lines come back as a table of their own."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftspark.operators.ordering import numbered
from siftspark.operators.sampling import chunks
from siftspark.session import checkpointed

LIBRARY = "smiles string, name string"


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(row_id, value): lines with their number in the input, from 0, files in order of their paths.

    A split of a file numbers its own lines; the counts of the splits before it, one row each, do the rest.
    """
    place = ["_path", "_block"]
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_i"))
    lines = checkpointed(lines)
    splits = lines.groupBy(*place).agg(F.count("*").alias("_n"), F.min("_i").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return lines.join(splits.select(*place, (before - F.col("_first")).alias("_shift")), place).select((F.col("_i") + F.col("_shift")).alias("row_id"), "value")


def tokens(value: Column) -> Column:
    """Whitespace-separated tokens without empty ones."""
    return F.array_remove(F.split(F.trim(F.regexp_replace(value, "\\s+", " ")), " "), "")


def parse_library(lines: DataFrame, strict: bool = True) -> tuple[DataFrame, DataFrame]:
    """(library, rejects) from lines (value, ...): two tokens exactly, or at least two of which the first two count."""
    parts = lines.withColumn("_t", tokens(F.col("value")))
    good = F.size("_t") == 2 if strict else F.size("_t") >= 2
    rest = [c for c in lines.columns if c != "value"]
    return parts.filter(good).select(*rest, F.get("_t", F.lit(0)).alias("smiles"), F.get("_t", F.lit(1)).alias("name")), parts.filter(~good).select(*rest, "value")


def library_or_fail(lines: DataFrame) -> DataFrame:
    """As strict parse_library, but a bad line raises when it is read."""
    parts = lines.withColumn("_t", tokens(F.col("value")))
    checked = F.when(F.size("_t") == 2, F.col("_t")).otherwise(F.raise_error(F.concat(F.lit("bad line: "), F.col("value"))).cast("array<string>"))
    return parts.withColumn("_t", checked).select(F.get("_t", F.lit(0)).alias("smiles"), F.get("_t", F.lit(1)).alias("name"))


def named_targets(lines: DataFrame, count_blank: bool = True) -> DataFrame:
    """(row_id, smiles, name): blank lines go, a missing name is mol_ and the line number from 1, with or without the blank lines."""
    parts = lines.withColumn("_t", tokens(F.col("value"))).filter(F.size("_t") > 0)
    parts = parts.withColumn("_n", F.col("row_id") + 1) if count_blank else numbered(parts, ["row_id"], "_n", 1)
    return parts.select("row_id", F.get("_t", F.lit(0)).alias("smiles"), F.coalesce(F.get("_t", F.lit(1)), F.concat(F.lit("mol_"), F.col("_n").cast("string"))).alias("name"))


def titled_molecules(lines: DataFrame) -> DataFrame:
    """(row_id, smiles, id): the id is all that follows the first token, or Mol_ and the line number from 1."""
    m = lines.filter(F.trim("value") != "").select("row_id", F.regexp_extract("value", "^\\s*(\\S+)", 1).alias("smiles"), F.trim(F.regexp_extract("value", "^\\s*\\S+\\s+(.*)$", 1)).alias("id"))
    return m.withColumn("id", F.when(F.col("id") == "", F.concat(F.lit("Mol_"), (F.col("row_id") + 1).cast("string"))).otherwise(F.col("id")))


def queries(lines: DataFrame) -> DataFrame:
    """(line_no, smiles, line): the first token of lines that are not blank, with the line number from 1 and the line as it was."""
    return lines.withColumn("_t", tokens(F.col("value"))).filter(F.size("_t") > 0).select((F.col("row_id") + 1).cast("int").alias("line_no"), F.get("_t", F.lit(0)).alias("smiles"), F.col("value").alias("line"))


def read_shards(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """Library rows of all files of a folder with the suffix, with the file they come from."""
    lines = spark.read.option("pathGlobFilter", f"*{suffix}").text(folder).select("value", F.col("_metadata.file_name").alias("file_name"))
    return parse_library(lines, strict=False)[0]


def shard_row_counts(spark: SparkSession, folder: str, suffix: str = "", header_lines: int = 0) -> DataFrame:
    """(file_name, n_rows): lines of each file but its header."""
    lines = spark.read.option("pathGlobFilter", f"*{suffix}").text(folder)
    return lines.groupBy(F.col("_metadata.file_name").alias("file_name")).agg((F.count("*") - header_lines).alias("n_rows"))


def without_nan(df: DataFrame) -> DataFrame:
    """NaN as null in all columns of floating point."""
    return df.select(*[F.when(~F.isnan(f"`{c}`"), F.col(f"`{c}`")).alias(c) if t in ("double", "float") else F.col(f"`{c}`") for c, t in df.dtypes])


def read_properties(spark: SparkSession, path: str | list[str], schema: str | T.StructType, header: bool = True, **options: str) -> DataFrame:
    """Delimited tables with a declared schema; NaN becomes null, names stay text."""
    return without_nan(spark.read.options(header=header, nanValue="nan", **options).schema(schema).csv(path))


def read_smi(spark: SparkSession, path: str | list[str], schema: str = LIBRARY) -> DataFrame:
    """Tables without a header, columns apart by one blank."""
    return read_properties(spark, path, schema, header=False, sep=" ")


def decoded_lines(files: DataFrame, encoding: str) -> DataFrame:
    """(value): the lines of whole files (content, binary) in any encoding that Python knows, such as GBK; bad bytes are replaced."""

    @F.pandas_udf("array<string>")
    def lines(content: pd.Series) -> pd.Series:
        return content.map(lambda x: bytes(x).decode(encoding, "replace").splitlines())

    return files.select(F.explode(lines("content")).alias("value"))


def read_encoded(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """(smiles, name) of a list in another encoding; each file is read whole, as such lists are short."""
    return parse_library(decoded_lines(spark.read.format("binaryFile").load(path), encoding))[0]


def labelled(df: DataFrame, smiles: str = "smiles", label: str | None = None, name: str | None = None, scaffold: str | None = None, default: float | None = None, exclude: list[str] | None = None) -> DataFrame:
    """(smiles, label, name, scaffold) of a collection; columns that are not named are null, a missing label is the default.

    With ``exclude`` the label is an array of all other columns, in their order.
    """
    column = lambda c, kind="string": (F.lit(None) if c is None else F.col(f"`{c}`")).cast(kind)
    if exclude is not None:
        value = F.array(*[F.col(f"`{c}`").cast("double") for c in df.columns if c not in {smiles, name, scaffold, *exclude}])
    else:
        value = F.coalesce(column(label, "double"), F.lit(default).cast("double"))
    return df.select(column(smiles).alias("smiles"), value.alias("label"), column(name).alias("name"), column(scaffold).alias("scaffold"))


def read_collection(spark: SparkSession, path: str, label: str | None = "label", default: float | None = None, exclude: list[str] | None = None, **names: str) -> DataFrame:
    """A collection by its suffix: .csv with a header, .smi with names after the SMILES, .txt with a SMILES a line."""
    if path.endswith(".csv"):
        return labelled(spark.read.csv(path, header=True, nanValue="nan"), label=label, default=default, exclude=exclude, **names)
    lines = spark.read.text(path).withColumn("_t", tokens(F.col("value"))).filter(F.size("_t") > 0)
    parts = lines.select(F.get("_t", F.lit(0)).alias("smiles"), (F.get("_t", F.lit(1)) if path.endswith(".smi") else F.lit(None).cast("string")).alias("name"))
    return labelled(parts, name="name", default=default)


def pairs(df: DataFrame, a: str = "smiles_i", b: str = "smiles_j", label: str = "label", a_name: str | None = None, b_name: str | None = None) -> DataFrame:
    """(a, b, label) of a table of pairs, each member a struct of name and smiles."""
    member = lambda s, n: F.struct((F.lit(None) if n is None else F.col(n)).cast("string").alias("name"), F.col(s).alias("smiles"))
    return df.select(member(a, a_name).alias("a"), member(b, b_name).alias("b"), F.col(label).cast("int").alias("label"))


def model_catalogue(df: DataFrame, path: str = "path") -> DataFrame:
    """The models that have a file."""
    return df.filter(F.col(path).isNotNull() & (F.trim(path) != ""))


def parse_sdf(files: DataFrame) -> DataFrame:
    """(file_name, record, title, n_atoms, n_bonds, fields, block) of structure files (file_name, value): records end at a line of four dollars."""
    records = files.select("file_name", F.posexplode(F.split("value", r"(?m)^\$\$\$\$\s*$\n?")).alias("record", "block")).filter(F.trim("block") != "")
    line = lambda k: F.get(F.split("block", "\n"), F.lit(k))
    entries = F.regexp_extract_all("block", F.lit(r"(?m)^> *<[^>]*>.*\n[^\n]*"), F.lit(0))
    fields = F.map_from_entries(F.transform(entries, lambda e: F.struct(F.regexp_extract(e, "<([^>]*)>", 1).alias("k"), F.element_at(F.split(e, "\n"), -1).alias("v"))))
    counts = line(3)
    return records.select("file_name", "record", F.trim(line(0)).alias("title"), F.trim(F.substring(counts, 1, 3)).try_cast("int").alias("n_atoms"), F.trim(F.substring(counts, 4, 3)).try_cast("int").alias("n_bonds"), fields.alias("fields"), "block")


def write_sdf(records: DataFrame, path: str, mode: str = "error") -> None:
    """The blocks, each with its end mark."""
    records.select(F.concat(F.rtrim("block"), F.lit("\n$$$$")).alias("value")).write.mode(mode).text(path)


def parse_fps(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((id, hex), rejects) of hex fingerprints: # and blank lines are skipped, others have two tokens."""
    rows = lines.filter(~F.startswith(F.trim("value"), F.lit("#")) & (F.trim("value") != "")).withColumn("_t", tokens(F.col("value")))
    good = F.size("_t") == 2
    return rows.filter(good).select(F.get("_t", F.lit(1)).alias("id"), F.get("_t", F.lit(0)).alias("hex")), rows.filter(~good).select("value")


def parse_sparse_bits(lines: DataFrame) -> DataFrame:
    """(id, bits) of lines id,bit,bit,..."""
    parts = F.split("value", ",")
    return lines.select(F.get(parts, F.lit(0)).alias("id"), F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: x.cast("int")).alias("bits"))


def parse_pose_scores(files: DataFrame, suffix: str = "_out.pdbqt") -> tuple[DataFrame, DataFrame]:
    """((score, name), rejects) of whole pose files (file_name, value): the fourth token of the second line."""
    line = F.get(F.split("value", "\n"), F.lit(1))
    score = F.expr("try_cast(_s AS DOUBLE)")
    rows = files.select(F.regexp_replace("file_name", suffix.replace(".", "\\.") + "$", "").alias("name"), F.get(tokens(line), F.lit(3)).alias("_s")).withColumn("score", score)
    return rows.filter("score IS NOT NULL").select("score", "name"), rows.filter("score IS NULL").select("name", "_s")


def parse_poses(lines: DataFrame) -> DataFrame:
    """(path, pose, affinity, rmsd_lb, rmsd_ub) of the result remarks, poses counted from 1 in line order.

    ``lines``: path and value, the whole file as text.
    """
    numbers = F.transform(tokens(F.regexp_extract("_line", "REMARK VINA RESULT:(.*)", 1)), lambda x: x.try_cast("double"))
    found = lines.select("path", F.posexplode(F.filter(F.split("value", "\n"), lambda x: F.startswith(x, F.lit("REMARK VINA RESULT:")))).alias("_i", "_line"))
    return found.select("path", (F.col("_i") + 1).alias("pose"), *[F.get(numbers, F.lit(i)).alias(n) for i, n in enumerate(("affinity", "rmsd_lb", "rmsd_ub"))])


def _fixed(column: str, first: int, length: int) -> Column:
    return F.trim(F.substring(column, first, length))


def parse_first_model(files: DataFrame) -> DataFrame:
    """(ligand, serial, atom, x, y, z, element) of the first model of whole pose files (ligand, value)."""
    first = F.substring_index("value", "ENDMDL", 1)
    lines = files.select("ligand", F.explode(F.split(first, "\n")).alias("_l")).filter(F.col("_l").rlike("^(ATOM|HETATM)"))
    number = lambda a, n: _fixed("_l", a, n).try_cast("double")
    return lines.select("ligand", _fixed("_l", 7, 5).try_cast("int").alias("serial"), _fixed("_l", 13, 4).alias("atom"), number(31, 8).alias("x"), number(39, 8).alias("y"), number(47, 8).alias("z"), _fixed("_l", 78, 2).alias("element"))


def parse_atoms(lines: DataFrame) -> DataFrame:
    """(chain, resnum, resname, element, hetero, x, y, z) of ATOM and HETATM records."""
    number = lambda a, n: _fixed("value", a, n).try_cast("double")
    rows = lines.filter(F.col("value").rlike("^(ATOM  |HETATM)"))
    return rows.select(
        _fixed("value", 22, 1).alias("chain"),
        _fixed("value", 23, 4).try_cast("int").alias("resnum"),
        _fixed("value", 18, 3).alias("resname"),
        _fixed("value", 77, 2).alias("element"),
        F.startswith("value", F.lit("HETATM")).alias("hetero"),
        number(31, 8).alias("x"),
        number(39, 8).alias("y"),
        number(47, 8).alias("z"),
    )


def parse_header(lines: DataFrame) -> DataFrame:
    """(rec, chain, resname) of SEQRES, MODRES and HET records; a SEQRES line gives a row per residue."""
    rec = _fixed("value", 1, 6)
    sequence = lines.filter(rec == "SEQRES").select(rec.alias("rec"), _fixed("value", 12, 1).alias("chain"), F.explode(tokens(F.substring("value", 20, 60))).alias("resname"))
    modified = lines.filter(rec == "MODRES").select(rec.alias("rec"), _fixed("value", 17, 1).alias("chain"), _fixed("value", 13, 3).alias("resname"))
    hetero = lines.filter(rec == "HET").select(rec.alias("rec"), _fixed("value", 13, 1).alias("chain"), _fixed("value", 8, 3).alias("resname"))
    return sequence.unionByName(modified).unionByName(hetero)


def parse_stats(lines: DataFrame) -> DataFrame:
    """(section, key, value) of lines of the form ``key: value`` or ``key = value``, a list in brackets as it is written.

    ``lines``: (row_id, value). A line ``[name]`` or ``name:`` alone opens a section; # begins a comment.
    """
    text = F.trim(F.regexp_replace("value", "#.*$", ""))
    heading = F.coalesce(F.nullif(F.regexp_extract(text, r"^\[([^\]]+)\]$", 1), F.lit("")), F.nullif(F.regexp_extract(text, r"^([^:=]+):$", 1), F.lit("")))
    rows = lines.select("row_id", text.alias("_t"), heading.alias("_h"))
    openings = rows.filter("_h IS NOT NULL").select(F.col("row_id").alias("_from"), F.col("_h").alias("section"))
    until = F.lead("_from").over(Window.orderBy("_from"))  # the few headings of a file
    spans = F.broadcast(openings.withColumn("_until", until))
    pair = lambda k: F.trim(F.regexp_extract("_t", "^([^:=]+)[:=](.+)$", k))
    values = rows.filter("_h IS NULL").select("row_id", pair(1).alias("key"), pair(2).alias("value")).filter("key != ''")
    inside = (F.col("row_id") > F.col("_from")) & (F.col("_until").isNull() | (F.col("row_id") < F.col("_until")))
    return values.join(spans, inside, "left").select("section", "key", "value")


def write_library(df: DataFrame, path: str, mode: str = "error") -> None:
    df.select(F.concat_ws(" ", "smiles", "name").alias("value")).write.mode(mode).text(path)


def write_properties(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_once(df: DataFrame, path: str) -> None:
    """Nothing happens where the output exists."""
    df.write.mode("ignore").parquet(path)


def write_fps(df: DataFrame, path: str, mode: str = "error", header: dict[str, str] | None = None) -> None:
    """Hex fingerprints (hex, id); header lines ``#key=value`` come first in every file."""
    head = [f"#{k}={v}" for k, v in ({"FPS": "1"} | (header or {})).items()]
    rows = df.select(F.concat_ws("\t", "hex", "id").alias("value"))

    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.record_batch([pa.array(head)], names=["value"])
        yield from (pa.record_batch([b.column(0).cast(pa.string())], names=["value"]) for b in batches)

    rows.mapInArrow(headed, "value string").write.mode(mode).text(path)


def write_scores(df: DataFrame, path: str, mode: str = "error") -> None:
    """score,name with a header."""
    df.select("score", "name").write.mode(mode).option("header", True).csv(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows to a table that may be there already: logs, experiments, rejected lines. See :mod:`siftspark.sources.commits` for
    appends that can be repeated."""
    df.write.mode("append").parquet(path)


def write_representations(df: DataFrame, path: str, mode: str = "error") -> None:
    """Rows with array columns, as Parquet."""
    df.write.mode(mode).parquet(path)


def write_matches(df: DataFrame, matrix: str, lines: str, mode: str = "error") -> None:
    """The 0/1 columns m0, m1 ... of rows (id, line) as a table, and the lines of those with a match; no match gives no lines."""
    hits = [c for c in df.columns if c[:1] == "m" and c[1:].isdigit()]
    df.select("id", *hits).write.mode(mode).option("header", True).csv(matrix)
    df.filter(F.greatest(*hits, F.lit(0)) > 0).select(F.col("line").alias("value")).write.mode(mode).text(lines)


def write_collection(df: DataFrame, path: str, kind: str, mode: str = "error") -> None:
    """A collection (smiles, label, name, ...) as csv with all columns, smi (SMILES and name) or txt (SMILES)."""
    if kind == "csv":
        write_properties(df, path, mode)
    elif kind == "smi":
        write_library(df, path, mode)
    elif kind == "txt":
        df.select(F.col("smiles").alias("value")).write.mode(mode).text(path)
    else:
        raise ValueError(f"unknown kind {kind}")


def write_pair_members(df: DataFrame, path: str, mode: str = "error") -> None:
    """The two members of pairs as two tables, with the pair's label."""
    for side in ("a", "b"):
        df.select(f"{side}.name", f"{side}.smiles", "label").write.mode(mode).option("header", True).csv(f"{path}/{side}")


def write_chunks(df: DataFrame, order: str, n_chunks: int, path: str, mode: str = "overwrite") -> None:
    """Lines in order, in contiguous chunks of equal size but for the last: a folder for each. What was there is replaced."""
    rows = chunks(df, order, n_chunks)
    rows.repartition("chunk").sortWithinPartitions("chunk", order).select("chunk", F.col(order).cast("string").alias("value")).write.mode(mode).partitionBy("chunk").text(path)


def similarity_table(sims: DataFrame, queries_: list[int]) -> DataFrame:
    """A row per target and a column per query of a stated list, three decimals or N/A."""
    wide = sims.groupBy("target").pivot("query", queries_).agg(F.first("sim"))
    return wide.select("target", *[F.when(F.col(f"`{q}`").isNotNull(), F.format_string("%.3f", F.col(f"`{q}`"))).otherwise("N/A").alias(f"query_{q}") for q in queries_])


def write_box(path: str, box: dict[str, float]) -> None:
    """The key-value file of a docking box, from one bounded row."""
    with open(path, "w") as out:
        out.writelines(f"{k} = {v}\n" for k, v in box.items())


def ranked_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns in a fixed order, numbers with four decimals."""
    kinds = dict(df.dtypes)
    return df.select(*[F.format_string("%.4f", c).alias(c) if kinds[c] == "double" else F.col(c) for c in columns if c in kinds])


def box_lines(box: DataFrame) -> DataFrame:
    """(value): the lines ``key = value`` of a one-row box, centre first."""
    keys = [f"{p}_{a}" for p in ("center", "size") for a in "xyz"]
    lines = F.array(*[F.concat(F.lit(f"{k} = "), F.col(k).cast("string")) for k in keys])
    return box.select(F.explode(lines).alias("value")).coalesce(1)
