"""Registered queries on formats: lines and files made from the driver's tables, read through the sources and written through the sinks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.functions import scalars
from siftspark.operators import clustering, joins, sampling, similarity, structure
from siftspark.plans.config import MODULES, gates
from siftspark.plans.queries import PRINTS_SQL, SIM_SQL, _prints
from siftspark.plans.registry import query, scratch
from siftspark.session import table
from siftspark.sources import commits, reports, text

def K() -> Column:  # noqa: N802
    return F.col("p_partkey")


def Z() -> Column:  # noqa: N802
    return F.col("p_size")


def _case(*values: Column, of: Column) -> Column:
    out = F.when(of == 0, values[0])
    for i, v in enumerate(values[1:], 1):
        out = out.when(of == i, v)
    return out


def _smiles() -> Column:
    return F.repeat(F.lit("C"), (Z() % 7 + 1).cast("int"))


SMILES_SQL = "repeat('C', (p_size % 7 + 1)::INTEGER)"


def _lines(s: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.lit("m"), K().cast("string"))
    value = _case(F.concat_ws(" ", _smiles(), name), F.concat(F.lit("  "), _smiles(), F.lit("\t "), name, F.lit(" ")), F.concat_ws(" ", _smiles(), name, F.lit("extra")), _smiles(), F.lit("  "), of=K() % 5)
    return table(s, d, "part").select(K().alias("row_id"), value.alias("value"))


LINES_SQL = f"""ln AS (SELECT p_partkey AS row_id, {SMILES_SQL} AS smi, 'm' || p_partkey AS nm, p_partkey % 5 AS kind,
  CASE p_partkey % 5 WHEN 0 THEN {SMILES_SQL} || ' m' || p_partkey WHEN 1 THEN '  ' || {SMILES_SQL} || chr(9) || ' m' || p_partkey || ' ' WHEN 2 THEN {SMILES_SQL} || ' m' || p_partkey || ' extra' WHEN 3 THEN {SMILES_SQL} ELSE '  ' END AS value FROM part)"""


def _line_file(s: SparkSession, d: str) -> DataFrame:
    """The lines as files in order, read and numbered again."""
    path = scratch(s)
    _lines(s, d).repartitionByRange(4, "row_id").sortWithinPartitions("row_id").select("value").write.text(path)
    return text.numbered_lines(s, path)


# --- libraries ---------------------------------------------------------------------------------


@query(f"WITH {LINES_SQL} SELECT row_id, CASE WHEN kind < 2 THEN smi END AS smiles, CASE WHEN kind < 2 THEN nm END AS name, kind >= 2 AS rejected FROM ln", "S1 K16 F1")
def library_strict(s: SparkSession, d: str) -> DataFrame:
    good, bad = text.parse_library(_lines(s, d))
    return good.withColumn("rejected", F.lit(False)).unionByName(bad.select("row_id", F.lit(True).alias("rejected")), allowMissingColumns=True)


@query(f"WITH {LINES_SQL} SELECT row_id, smi AS smiles, nm AS name FROM ln WHERE kind < 3", "S2")
def library_lenient(s: SparkSession, d: str) -> DataFrame:
    return text.parse_library(_lines(s, d), strict=False)[0]


@query(f"WITH {LINES_SQL} SELECT smi AS smiles, nm AS name FROM ln WHERE kind < 2", "S3")
def library_failfast(s: SparkSession, d: str) -> DataFrame:
    return text.library_or_fail(_lines(s, d).filter("row_id % 5 IN (0, 1)"))


@query(f"WITH {LINES_SQL} SELECT row_id, smi AS smiles, CASE WHEN kind < 3 THEN nm ELSE 'mol_' || (row_id + 1) END AS by_line, CASE WHEN kind < 3 THEN nm ELSE 'mol_' || ROW_NUMBER() OVER (ORDER BY row_id) END AS by_count FROM ln WHERE kind < 4", "S4")
def target_names(s: SparkSession, d: str) -> DataFrame:
    lines = _line_file(s, d)
    counted = text.named_targets(lines, count_blank=False).select("row_id", F.col("name").alias("by_count"))
    return text.named_targets(lines).withColumnRenamed("name", "by_line").join(counted, "row_id")


@query(f"WITH {LINES_SQL} SELECT row_id, smi AS smiles, CASE kind WHEN 2 THEN nm || ' extra' WHEN 3 THEN 'Mol_' || (row_id + 1) ELSE nm END AS id FROM ln WHERE kind < 4", "S5")
def molecule_titles(s: SparkSession, d: str) -> DataFrame:
    return text.titled_molecules(_line_file(s, d))


@query(f"WITH {LINES_SQL} SELECT (row_id + 1)::INTEGER AS line_no, smi AS smiles, value AS line FROM ln WHERE kind < 4", "S6")
def query_lines(s: SparkSession, d: str) -> DataFrame:
    return text.queries(_line_file(s, d))


def _library(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "part").select(_smiles().alias("smiles"), F.concat(F.lit("m"), K().cast("string")).alias("name"), K().alias("row_id"))


@query(f"SELECT {SMILES_SQL} AS smiles, 'm' || p_partkey AS name FROM part", "S7 K1")
def smi_files(s: SparkSession, d: str) -> DataFrame:
    path = scratch(s)
    text.write_library(_library(s, d), path)
    return text.read_smi(s, path)


@query(f"SELECT {SMILES_SQL} AS smiles, '分子é' || p_partkey AS name FROM part", "S24")
def encoded_list(s: SparkSession, d: str) -> DataFrame:
    """A file for each row, with two lines of which the first is blank."""
    @F.pandas_udf("binary")
    def encoded(lines: pd.Series) -> pd.Series:
        return lines.map(lambda x: x.encode("gb18030"))

    files = table(s, d, "part").select(encoded(F.concat(F.lit("\n"), _smiles(), F.lit(" 分子é"), K().cast("string"), F.lit("\n"))).alias("content"))
    return text.parse_library(text.decoded_lines(files, "gb18030"))[0]


@query("SELECT 'm' || p_partkey AS name, CASE WHEN p_partkey % 3 > 0 THEN p_retailprice END AS MW, p_size AS nHA FROM part", "K2 S16 S17 K12 U7")
def property_files(s: SparkSession, d: str) -> DataFrame:
    path = scratch(s)
    props = table(s, d, "part").select(F.concat(F.lit("m"), K().cast("string")).alias("name"), F.when(K() % 3 > 0, F.col("p_retailprice")).otherwise(float("nan")).alias("MW"), Z().alias("nHA"), K())
    for part in (0, 1):
        text.write_properties(props.filter(K() % 2 == part).drop("p_partkey"), f"{path}/{part}")
    return text.read_properties(s, [f"{path}/0", f"{path}/1"], "name string, MW double, nHA int")


@query("SELECT p_size AS size, p_partkey % 7 AS v FROM part WHERE p_partkey % 2 = 0", "K3 S15")
def written_once(s: SparkSession, d: str) -> DataFrame:
    path, rows = scratch(s), table(s, d, "part").select(Z().alias("size"), (K() % 7).alias("v"), K())
    text.write_once(rows.filter(K() % 2 == 0).drop("p_partkey"), path)
    text.write_once(rows.drop("p_partkey"), path)  # changes nothing
    return s.read.parquet(path)


@query("SELECT 'm' || p_partkey AS name, -p_size / 10.0 AS score FROM part", "K4")
def score_files(s: SparkSession, d: str) -> DataFrame:
    path = scratch(s)
    text.write_scores(table(s, d, "part").select(F.concat(F.lit("m"), K().cast("string")).alias("name"), (-Z() / F.lit(10.0)).alias("score")), path)
    return text.read_properties(s, path, "score double, name string").select("name", "score")


def _collection(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "part").select(_smiles().alias("smiles"), F.when(K() % 4 > 0, (Z() % 2).cast("double")).alias("label"), F.concat(F.lit("m"), K().cast("string")).alias("name"), F.col("p_brand").alias("scaffold"))


COLLECTION_SQL = f"SELECT {SMILES_SQL} AS smiles, p_partkey, p_size, 'm' || p_partkey AS name, p_brand FROM part"


@query(f"SELECT smiles, CASE WHEN p_partkey % 4 > 0 THEN (p_size % 2)::DOUBLE ELSE -1 END AS label, name, p_brand AS scaffold FROM ({COLLECTION_SQL}) UNION ALL SELECT smiles, 0.5, name, NULL FROM ({COLLECTION_SQL}) UNION ALL SELECT smiles, NULL, NULL, NULL FROM ({COLLECTION_SQL})", "S8 S10 K17")
def collection_files(s: SparkSession, d: str) -> DataFrame:
    path = scratch(s)
    for kind in ("csv", "smi", "txt"):
        text.write_collection(_collection(s, d), f"{path}/a.{kind}", kind)
    csv = text.read_collection(s, f"{path}/a.csv", default=-1.0, name="name", scaffold="scaffold")
    return csv.unionByName(text.read_collection(s, f"{path}/a.smi", default=0.5)).unionByName(text.read_collection(s, f"{path}/a.txt"))


@query("SELECT 'm' || p_partkey AS name, (p_size % 2)::DOUBLE AS l0, (p_partkey % 3)::DOUBLE AS l1 FROM part", "S10")
def multi_label_collection(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "part").select(_smiles().alias("smiles"), F.concat(F.lit("m"), K().cast("string")).alias("name"), F.col("p_brand").alias("note"), (Z() % 2).alias("a"), (K() % 3).alias("b"))
    found = text.labelled(rows, name="name", exclude=["note"])
    return found.select("name", F.get("label", F.lit(0)).alias("l0"), F.get("label", F.lit(1)).alias("l1"))


@query(f"SELECT 'a' AS side, NULL AS name, {SMILES_SQL} AS smiles, (p_size % 2)::INTEGER AS label FROM part UNION ALL SELECT 'b', NULL, 'O', (p_size % 2)::INTEGER FROM part", "S9 S11 K17")
def pair_files(s: SparkSession, d: str) -> DataFrame:
    path = scratch(s)
    rows = table(s, d, "part").select(_smiles().alias("smiles_i"), F.lit("O").alias("smiles_j"), (Z() % 2).alias("label"))
    text.write_properties(rows, f"{path}/in")
    text.write_pair_members(text.pairs(s.read.csv(f"{path}/in", header=True)), f"{path}/out")
    side = lambda k: text.read_properties(s, f"{path}/out/{k}", "name string, smiles string, label int").withColumn("side", F.lit(k))
    return side("a").unionByName(side("b"))


@query("WITH n AS (SELECT COUNT(*) AS n FROM part) SELECT 'm' || lpad(p_partkey::VARCHAR, 9, '0') AS value, FLOOR(p_partkey / CEIL(n / 7.0))::INTEGER AS chunk FROM part, n", "K18 W5 O10")
def name_chunks(s: SparkSession, d: str) -> DataFrame:
    path = scratch(s)
    text.write_chunks(table(s, d, "part").select(F.concat(F.lit("m"), F.lpad(K().cast("string"), 9, "0")).alias("name")), "name", 7, path)
    return s.read.text(path)


@query(f"SELECT {SMILES_SQL} AS smiles, 'm' || p_partkey AS name, COUNT(*) OVER () AS n_rows FROM part", "S12 S31")
def shard_files(s: SparkSession, d: str) -> DataFrame:
    path, lines = scratch(s), _library(s, d).select(F.concat_ws(" ", "smiles", "name", F.lit("x")).alias("value"), "row_id")
    lines.repartition(3, "row_id").select("value").write.text(path)
    s.createDataFrame([("not a shard",)], "value string").coalesce(1).write.mode("append").option("compression", "gzip").text(path)
    total = text.shard_row_counts(s, path, ".txt", header_lines=1).agg((F.sum("n_rows") + F.count("*")).alias("n_rows"))
    return text.read_shards(s, path, ".txt").drop("file_name").crossJoin(F.broadcast(total))


# --- fingerprints ------------------------------------------------------------------------------


@query(f"WITH {PRINTS_SQL} SELECT 'v' || id AS id, len(bits)::INTEGER AS n_bits, TRUE AS same FROM fp", "S13 S14 K11 F21 C5")
def fps_files(s: SparkSession, d: str) -> DataFrame:
    path = scratch(s)
    prints = _prints(s, d).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("id"), "fp")
    text.write_fps(prints.select("id", similarity.to_hex(F.col("fp")).alias("hex")), path, header={"num_bits": "64"})
    back, _ = text.parse_fps(s.read.text(path))
    words = back.select("id", similarity.from_hex(F.col("hex")).alias("_fp")).join(prints, "id")
    return words.select("id", similarity.popcount(F.col("_fp")).alias("n_bits"), (F.col("_fp") == F.col("fp")).alias("same"))


@query(f"WITH {PRINTS_SQL} SELECT 'v' || id AS id, array_to_string(bits, ' ') AS on_bits, array_to_string(list_transform(range(64), lambda i: list_contains(bits, i)::INTEGER), '') AS flags FROM fp", "S22 F20")
def sparse_bit_lines(s: SparkSession, d: str) -> DataFrame:
    lines = _prints(s, d).select(F.concat_ws(",", F.concat(F.lit("v"), F.col("id").cast("string")), F.array_join(F.col("bits").cast("array<string>"), ",")).alias("value"))
    flags = similarity.dense(F.col("bits"), 64)
    rows = text.parse_sparse_bits(lines).withColumn("_f", flags)
    return rows.select("id", F.array_join(similarity.sparse(F.col("_f")).cast("array<string>"), " ").alias("on_bits"), F.array_join(F.col("_f").cast("array<string>"), "").alias("flags"))


@query(f"WITH {PRINTS_SQL}, q AS (SELECT a.id AS target, b.id AS query, printf('%.3f', ROUND({SIM_SQL}, 3)) AS sim FROM fp a, fp b WHERE b.id IN (0, 20) AND a.id % 7 > 0) SELECT target, COALESCE(MAX(CASE WHEN query = 0 THEN sim END), 'N/A') AS query_0, COALESCE(MAX(CASE WHEN query = 20 THEN sim END), 'N/A') AS query_20, 'N/A' AS query_21 FROM q GROUP BY 1", "K5 F8")
def similarity_columns(s: SparkSession, d: str) -> DataFrame:
    fp = _prints(s, d)
    sims = similarity.similarity_matrix(fp.filter("id % 7 > 0"), fp.filter("id IN (0, 20)"))
    return text.similarity_table(sims, [0, 20, 21])


# --- poses and structures ----------------------------------------------------------------------


def _poses(s: SparkSession, d: str) -> DataFrame:
    score = F.when(K() % 7 == 0, F.lit("N/A")).otherwise(F.format_string("%.1f", -Z() / F.lit(10.0)))
    remark = lambda x, i: F.concat(F.lit("REMARK VINA RESULT:    "), x, F.lit(f"      {i}.000      {i}.500\n"))
    value = F.when(K() % 11 == 0, F.lit("MODEL 1")).otherwise(F.concat(F.lit("MODEL 1\n"), remark(score, 0), F.lit("ENDMDL\nMODEL 2\n"), remark(F.format_string("%.1f", -Z() / F.lit(20.0)), 1), F.lit("ENDMDL\n")))
    path = F.concat(F.lit("/dock/out.d/lig"), K().cast("string"), F.lit("_out.pdbqt"))
    return table(s, d, "part").select(path.alias("path"), value.alias("value"))


@query("SELECT 'lig' || p_partkey AS name, 'lig' || p_partkey || '_out' AS stem, CASE WHEN p_partkey % 7 > 0 AND p_partkey % 11 > 0 THEN ROUND(-p_size / 10.0::DOUBLE, 1) END AS score FROM part", "S18 F3 F10")
def pose_scores(s: SparkSession, d: str) -> DataFrame:
    files = _poses(s, d).withColumn("file_name", scalars.base_name(F.col("path")))
    good, bad = text.parse_pose_scores(files)
    rows = good.unionByName(bad.select("name"), allowMissingColumns=True)
    stems = files.select(scalars.base_name(F.col("path"), "_out.pdbqt").alias("name"), F.regexp_replace("file_name", "[.]pdbqt$", "").alias("stem"))
    return rows.join(stems, "name").select("name", "stem", "score")


@query("""SELECT 'lig' || p_partkey AS name, pose::INTEGER AS pose, CASE WHEN pose = 2 THEN ROUND(-p_size / 20.0::DOUBLE - 1e-9, 1) WHEN p_partkey % 7 > 0 THEN ROUND(-p_size / 10.0::DOUBLE, 1) END AS affinity, pose - 1.0::DOUBLE AS rmsd_lb, pose - 0.5::DOUBLE AS rmsd_ub
FROM part, (VALUES (1), (2)) v(pose) WHERE p_partkey % 11 > 0""", "S19 2.13-UDTF")
def pose_parse(s: SparkSession, d: str) -> DataFrame:
    return text.parse_poses(_poses(s, d)).select(scalars.base_name(F.col("path"), "_out.pdbqt").alias("name"), "pose", "affinity", "rmsd_lb", "rmsd_ub")


ATOM = "%-6s%5d  %-3s %3s %1s%4d    %8.3f%8.3f%8.3f  1.00  0.00          %2s"


def _atom_lines(s: SparkSession, d: str) -> DataFrame:
    """A fixed-width line for each line item: protein atoms, ligand atoms and water."""
    n, k = F.col("l_linenumber"), F.col("l_orderkey")
    record = F.when(n <= 3, "ATOM").otherwise("HETATM")
    resname = F.when(n <= 3, F.when(n == 1, "ALA").otherwise("GLY")).when(n == 4, "HOH").when(n == 5, "DG").otherwise("LIG")
    element = F.when(n % 2 == 0, "C").otherwise("O")
    at = lambda c, m: (F.col(c) % F.lit(m)).cast("double")
    value = F.format_string(ATOM, record, (k % 10000).cast("int"), F.concat(element, n.cast("string")), resname, F.lit("A"), (F.col("l_suppkey") % 1000).cast("int"), at("l_partkey", 97), at("l_suppkey", 13) - 5, at("l_orderkey", 11) / 4, element)
    return table(s, d, "lineitem").select(k.alias("ligand"), n.alias("n"), value.alias("value"), record.alias("record"), resname.alias("resname"))


ATOMS_SQL = """ao AS (SELECT l_orderkey AS ligand, l_linenumber AS n, l_linenumber > 3 AS hetero, CASE l_linenumber WHEN 1 THEN 'ALA' WHEN 2 THEN 'GLY' WHEN 3 THEN 'GLY' WHEN 4 THEN 'HOH' WHEN 5 THEN 'DG' ELSE 'LIG' END AS resname,
  CASE WHEN l_linenumber % 2 = 0 THEN 'C' ELSE 'O' END AS element, (l_orderkey % 10000)::INTEGER AS serial, 'A' AS chain, (l_suppkey % 1000)::INTEGER AS resnum, (l_partkey % 97)::DOUBLE AS x, (l_suppkey % 13)::DOUBLE - 5 AS y, (l_orderkey % 11)::DOUBLE / 4 AS z FROM lineitem)"""


@query(f"WITH {ATOMS_SQL} SELECT chain, resnum, resname, element, hetero, x, y, z FROM ao", "S20 F2")
def pdb_parse(s: SparkSession, d: str) -> DataFrame:
    return text.parse_atoms(_atom_lines(s, d).select("value"))


@query(f"WITH {ATOMS_SQL} SELECT ligand, serial, element || n AS atom, x, y, z, element FROM ao WHERE n <= 2", "S20")
def first_model(s: SparkSession, d: str) -> DataFrame:
    """Files of two models; only the first, with line numbers 1 and 2, counts."""
    lines = _atom_lines(s, d).groupBy("ligand").agg(F.sort_array(F.collect_list(F.struct("n", "value"))).alias("_l"))  # the few atoms of one file
    model = lambda keep: F.array_join(F.transform(F.filter("_l", keep), lambda x: x["value"]), "\n")
    files = lines.select("ligand", F.concat(F.lit("MODEL 1\n"), model(lambda x: x["n"] <= 2), F.lit("\nENDMDL\nMODEL 2\n"), model(lambda x: x["n"] > 2), F.lit("\nENDMDL\n")).alias("value"))
    return text.parse_first_model(files)


@query("SELECT 'SEQRES' AS rec, 'A' AS chain, CASE v.k WHEN 0 THEN 'ALA' ELSE 'GLY' END AS resname, COUNT(*) AS n FROM part, (VALUES (0), (1), (2)) v(k) WHERE p_partkey % 3 = 0 GROUP BY 1, 2, 3 UNION ALL SELECT CASE p_partkey % 3 WHEN 1 THEN 'MODRES' ELSE 'HET' END, 'B', CASE p_partkey % 3 WHEN 1 THEN 'MSE' ELSE 'LIG' END, COUNT(*) FROM part WHERE p_partkey % 3 > 0 GROUP BY 1, 2, 3", "S21")
def pdb_header(s: SparkSession, d: str) -> DataFrame:
    value = _case(F.format_string("SEQRES %3d A  153  ALA GLY GLY", (K() % 100).cast("int")), F.lit("MODRES 1ABC MSE B   10  MET"), F.lit("HET    LIG  B 201      20"), of=K() % 3)
    return text.parse_header(table(s, d, "part").select(value.alias("value"))).groupBy("rec", "chain", "resname").agg(F.count("*").alias("n"))


@query(f"WITH {ATOMS_SQL} SELECT chain, resnum, resname, COUNT(*) AS n_atoms, bool_or(element = 'C') AS has_carbon FROM ao GROUP BY 1, 2, 3", "A22")
def residue_groups(s: SparkSession, d: str) -> DataFrame:
    return structure.residues(text.parse_atoms(_atom_lines(s, d).select("value")))


@query(f"WITH {ATOMS_SQL} SELECT chain, resnum, resname, COUNT(*) AS n_atoms FROM ao WHERE hetero AND resname NOT IN ('HOH', 'DG') GROUP BY 1, 2, 3 HAVING bool_or(element = 'C') ORDER BY n_atoms DESC, chain, resnum, resname LIMIT 1", "O3 U8 C16")
def largest_ligand(s: SparkSession, d: str) -> DataFrame:
    header = s.createDataFrame([("SEQRES", "A", "DG"), ("HET", "A", "LIG")], "rec string, chain string, resname string")
    found = structure.ligands(text.parse_atoms(_atom_lines(s, d).select("value")), header)
    return structure.largest_ligand(found).select("chain", "resnum", "resname", "n_atoms")


@query(f"WITH {ATOMS_SQL} SELECT 'protein' AS part, COUNT(*) AS n FROM ao WHERE NOT hetero UNION ALL SELECT 'bases', COUNT(*) FROM ao WHERE resname = 'DG' UNION ALL SELECT 'ligand', COUNT(*) FROM ao WHERE hetero AND resname = 'LIG' UNION ALL SELECT 'near', COUNT(*) FROM ao WHERE chain = 'A' AND resnum BETWEEN 5 AND 9 AND (resname = 'HOH' OR element IN ('O', 'N'))", "P24 P25")
def atom_selections(s: SparkSession, d: str) -> DataFrame:
    atoms = text.parse_atoms(_atom_lines(s, d).select("value"))
    words = {"protein": "protein", "bases": "nucleotide or nucleoside", "ligand": "hetero and not (water or nucleotide)", "near": "chain A and resnum 5 to 9 and (water or element O N)"}
    return atoms.agg(*[F.count_if(structure.selection(w)).alias(k) for k, w in words.items()]).unpivot([], list(words), "part", "n")


@query("SELECT 'f' || p_partkey AS file_name, r::INTEGER AS record, 'mol' || r AS title, 2 AS n_atoms, 1 AS n_bonds, (p_size + r)::VARCHAR AS score, 'x y' AS note FROM part, (VALUES (0), (1)) v(r)", "S26")
def sdf_records(s: SparkSession, d: str) -> DataFrame:
    block = lambda r: F.concat(F.lit(f"mol{r}\n  tool\n\n  2  1  0  0  0\n    0.0 0.0 0.0 C\n    1.5 0.0 0.0 O\n  1  2  1  0\nM  END\n> <score>\n"), (Z() + r).cast("string"), F.lit("\n\n>  <note>\nx y\n\n$$$$\n"))
    files = table(s, d, "part").select(F.concat(F.lit("f"), K().cast("string")).alias("file_name"), F.concat(block(0), block(1)).alias("value"))
    path, found = scratch(s), text.parse_sdf(files)
    text.write_sdf(found, path)
    again = text.parse_sdf(s.read.text(path, lineSep="$$$$\n").select(F.lit("").alias("file_name"), F.concat("value", F.lit("$$$$\n")).alias("value"))).groupBy("title").agg(F.count("*").alias("_n"))
    return found.join(again, "title").filter("_n > 0").select("file_name", "record", "title", "n_atoms", "n_bonds", F.col("fields")["score"].alias("score"), F.col("fields")["note"].alias("note"))


@query(f"WITH {ATOMS_SQL} SELECT * FROM (SELECT 'center_x' AS key, ROUND((MAX(x) + MIN(x)) / 2, 4) AS value FROM ao UNION ALL SELECT 'center_y', ROUND((MAX(y) + MIN(y)) / 2, 4) FROM ao UNION ALL SELECT 'center_z', ROUND((MAX(z) + MIN(z)) / 2, 4) FROM ao UNION ALL SELECT 'size_x', GREATEST(MAX(x) - MIN(x) + 5, 20) FROM ao UNION ALL SELECT 'size_y', GREATEST(MAX(y) - MIN(y) + 5, 20) FROM ao UNION ALL SELECT 'size_z', GREATEST(MAX(z) - MIN(z) + 5, 20) FROM ao)", "K13 A20 F24")
def box_file(s: SparkSession, d: str) -> DataFrame:
    path = scratch(s)
    text.box_lines(structure.bounding_box(text.parse_atoms(_atom_lines(s, d).select("value")), extend=5.0, least=20.0)).write.text(path)
    values = text.parse_stats(text.numbered_lines(s, path))
    return values.select("key", F.col("value").cast("double").alias("value")).join(s.createDataFrame([(f"{p}_{a}",) for p in ("center", "size") for a in "xyz"], "key string"), "key")


# --- settings, statistics, logs ----------------------------------------------------------------


@query("SELECT CASE WHEN p_partkey % 2 = 0 THEN 'model' ELSE 'data' END AS section, 'k' || p_partkey AS key, '[' || p_size || ', 2]' AS value FROM part", "S29")
def stats_file(s: SparkSession, d: str) -> DataFrame:
    path = scratch(s)
    parts = table(s, d, "part").select(F.concat(F.lit("k"), K().cast("string"), F.when(K() % 3 == 0, F.lit(" = [")).otherwise(F.lit(": [")), Z().cast("string"), F.lit(", 2]  # note")).alias("value"), (K() % 2).alias("o"), (K() + 1).alias("p"))
    heads = s.createDataFrame([("[model]", 0, 0), ("data:", 1, 0), ("# nothing", 1, 1)], "value string, o bigint, p bigint")
    parts.unionByName(heads).repartitionByRange(2, "o", "p").sortWithinPartitions("o", "p").select("value").write.text(path)
    return text.parse_stats(text.numbered_lines(s, path))


@query("SELECT p_name AS property, p_partkey AS model_no, '/m/' || p_partkey AS path FROM part WHERE p_partkey % 5 > 1", "S27")
def catalogue_rows(s: SparkSession, d: str) -> DataFrame:
    path = F.when(K() % 5 == 0, F.lit(None)).when(K() % 5 == 1, F.lit(" ")).otherwise(F.concat(F.lit("/m/"), K().cast("string")))
    return text.model_catalogue(table(s, d, "part").select(F.col("p_name").alias("property"), K().alias("model_no"), path.alias("path")))


@query("WITH m AS (SELECT * FROM (VALUES ('library', 0), ('physchem', 1), ('admet', 2), ('druglikeness', 3), ('docking', 4), ('results', 5)) m(m, i)) SELECT c_custkey AS run, m AS module, i >= c_custkey % 6 AND i <> c_nationkey % 6 AS runs FROM customer, m", "S28 P28 F31 2.16-main")
def module_gate(s: SparkSession, d: str) -> DataFrame:
    """Which modules each run goes through: it starts with one and leaves one out."""
    order = F.array(*map(F.lit, MODULES))
    at = lambda c: F.get(order, (F.col(c) % 6).cast("int"))
    settings = table(s, d, "customer").select(F.col("c_custkey").alias("run"), at("c_custkey").alias("start"), F.array_remove(order, at("c_nationkey")).alias("active"))
    return gates(settings).select("run", "module", "runs")


@query("SELECT 'box' AS kind, p_partkey AS k, p_size AS v FROM part UNION ALL SELECT 'again', p_partkey, p_size + 1 FROM part WHERE p_partkey % 2 = 0", "K14 K15 K16")
def appended_rows(s: SparkSession, d: str) -> DataFrame:
    path, rows = scratch(s), table(s, d, "part")
    text.append_rows(rows.select(F.lit("box").alias("kind"), K().alias("k"), Z().alias("v")), path)
    text.append_rows(rows.filter(K() % 2 == 0).select(F.lit("again").alias("kind"), K().alias("k"), (Z() + 1).alias("v")), path)
    return s.read.parquet(path)


@query("SELECT 'box' AS kind, p_partkey AS k, p_size AS v FROM part UNION ALL SELECT 'again', p_partkey, p_size + 1 FROM part WHERE p_partkey % 2 = 0", "K14 K15 K16 E9")
def committed_rows(s: SparkSession, d: str) -> DataFrame:
    """Two jobs append, one of them twice; a third has written its rows and was stopped before its manifest."""
    path, rows = scratch(s), table(s, d, "part")
    first = rows.select(F.lit("box").alias("kind"), K().alias("k"), Z().alias("v"))
    commits.append(first, path, "first")
    commits.append(rows.filter(K() % 2 == 0).select(F.lit("again").alias("kind"), K().alias("k"), (Z() + 1).alias("v")), path, "second")
    commits.append(first, path, "first")
    first.write.parquet(f"{path}/data/job=stopped")
    return commits.read(s, path)



@query("SELECT vec_id, len(embedding)::INTEGER AS width, ROUND(embedding[1]::DOUBLE, 6) AS first, ROUND(embedding[64]::DOUBLE, 6) AS last FROM embeddings", "K19")
def representation_files(s: SparkSession, d: str) -> DataFrame:
    path = scratch(s)
    text.write_representations(table(s, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")), path)
    return s.read.parquet(path).select("vec_id", F.size("embedding").alias("width"), F.round(F.get("embedding", F.lit(0)), 6).alias("first"), F.round(F.get("embedding", F.lit(63)), 6).alias("last"))


@query("SELECT page_id AS id, CAST(contains(html, '<table') AS INTEGER) AS m0, CAST(contains(html, '<li>') AS INTEGER) AS m1, CASE WHEN contains(html, '<table') OR contains(html, '<li>') THEN 1 ELSE 0 END AS n_lines FROM pages", "K6")
def match_files(s: SparkSession, d: str) -> DataFrame:
    from siftspark.operators import filters

    path = scratch(s)
    rows = filters.matches_any(table(s, d, "pages"), "html", ("<table", "<li>")).select(F.col("page_id").alias("id"), F.concat(F.lit("page "), F.col("page_id").cast("string")).alias("line"), "m0", "m1")
    text.write_matches(rows, f"{path}/matrix", f"{path}/lines")
    lines = s.read.text(f"{path}/lines").groupBy(F.regexp_extract("value", "(\\d+)", 1).cast("bigint").alias("id")).agg(F.count("*").cast("int").alias("_n"))
    return text.read_properties(s, f"{path}/matrix", "id bigint, m0 int, m1 int").join(lines, "id", "left").select("id", "m0", "m1", F.coalesce("_n", F.lit(0)).alias("n_lines"))


CLUSTERS_SQL = "cl AS (SELECT p_partkey AS member, MIN(p_partkey) OVER (PARTITION BY p_brand) AS centroid, CASE WHEN p_partkey = MIN(p_partkey) OVER (PARTITION BY p_brand) THEN 1.0 ELSE p_size / 100.0 END::DOUBLE AS sim, COUNT(*) OVER (PARTITION BY p_brand) AS n_members FROM part)"


def _clusters(s: SparkSession, d: str) -> DataFrame:
    part = table(s, d, "part")
    first = part.groupBy("p_brand").agg(F.min("p_partkey").alias("centroid"))
    return part.join(first, "p_brand").select(K().alias("member"), "centroid", F.when(K() == F.col("centroid"), 1.0).otherwise(Z() / F.lit(100.0)).alias("sim"))


@query(f"WITH {CLUSTERS_SQL} SELECT (ROW_NUMBER() OVER (ORDER BY n_members DESC, centroid, CASE WHEN member = centroid THEN 0 ELSE 1 END, sim DESC, member) - 1)::BIGINT AS row_id, CASE WHEN member = centroid THEN 'cluster' || chr(9) || centroid || chr(9) || n_members ELSE 'member' || chr(9) || member || chr(9) || printf('%.3f', sim) END AS value FROM cl", "K7 O4 G4")
def cluster_report(s: SparkSession, d: str) -> DataFrame:
    path = scratch(s)
    clustering.write_report(_clusters(s, d), path)
    return text.numbered_lines(s, path)


@query(f"WITH {CLUSTERS_SQL} SELECT centroid, n_members, n_members = 1 AS singleton, p_name || ' ' || centroid AS line FROM cl JOIN part ON p_partkey = centroid WHERE member = centroid", "K7 G2 G3 O4")
def cluster_representatives(s: SparkSession, d: str) -> DataFrame:
    path, clusters = scratch(s), _clusters(s, d)
    clustering.write_representatives(clusters, table(s, d, "part").select(K().alias("id"), F.col("p_name").alias("smiles")), path)
    lines = s.read.text(path).select(F.col("value").alias("line"), F.regexp_extract("value", "(\\d+)$", 1).cast("bigint").alias("centroid"))
    return clustering.cluster_sizes(clusters).join(lines, "centroid")


@query("SELECT RANK() OVER (ORDER BY p_retailprice DESC)::INTEGER AS rank, p_partkey AS name, printf('%.4f', p_retailprice) AS score FROM part", "K8 P20")
def ranked_rows(s: SparkSession, d: str) -> DataFrame:
    from siftspark.operators import filters, scoring

    path = scratch(s)
    rows = scoring.ranked(table(s, d, "part").select(K().alias("compound"), F.col("p_retailprice").alias("score"), F.lit(None).cast("double").alias("empty")), "score")
    arranged = filters.arranged(rows, {"compound": "name"}, ["rank", "name", "score", "empty", "absent"], optional=["empty", "absent"])
    text.write_properties(text.ranked_table(arranged, ["rank", "name", "score", "empty"]), path)
    return s.read.csv(path, header=True, schema="rank int, name bigint, score string")


@query("SELECT rank::INTEGER AS rank, p_partkey AS name, CASE WHEN rank <= 10 THEN 'first' WHEN rank <= 50 THEN 'good' ELSE 'rest' END AS kind FROM (SELECT p_partkey, RANK() OVER (ORDER BY p_retailprice DESC) AS rank FROM part) ORDER BY rank, p_partkey LIMIT 500", "K10 K9 O2")
def report_rows(s: SparkSession, d: str) -> DataFrame:
    """The rows of the HTML report, taken out of it again."""
    from siftspark.operators import scoring

    top = scoring.top_n(scoring.ranked(table(s, d, "part").select(K().alias("name"), F.col("p_retailprice").alias("score")), "score"), 500, "name").select("rank", "name")
    page = s.createDataFrame([(reports.html_report("Ranked", top),)], "html string")
    cells = F.regexp_extract_all("html", F.lit('<tr class="(\\w+)"><td>(\\d+)</td><td>(\\d+)</td>'), F.lit(0))
    part = lambda k: F.regexp_extract("r", '<tr class="(\\w+)"><td>(\\d+)</td><td>(\\d+)</td>', k)
    return page.select(F.explode(cells).alias("r")).select(part(2).cast("int").alias("rank"), part(3).cast("bigint").alias("name"), part(1).alias("kind"))


@query("SELECT p_partkey AS name, p_size AS v, k::INTEGER AS copy FROM part, range(1, 4) r(k) WHERE k <= p_size % 4", "F22")
def repeated_rows(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "part").filter(Z() % 4 > 0)
    return rows.select(K().alias("name"), Z().alias("v"), F.explode(scalars.repeat_rows((Z() % 4).cast("int"))).alias("copy"))


@query("SELECT p_partkey AS name, replace(replace(p_type || '/' || p_name, '/', '_'), ' ', '_') AS safe, printf('%.3f', p_retailprice) AS fixed, format('{:,}', (p_retailprice * 1000)::BIGINT) AS grouped, (p_size % 2)::INTEGER AS flipped, CASE p_size % 3 WHEN 0 THEN '100' WHEN 1 THEN '010' ELSE '001' END AS one_hot FROM part", "F5 F8 F28 F30 F4")
def scalar_columns(s: SparkSession, d: str) -> DataFrame:
    hot = scalars.one_hot((Z() % 3).cast("int"), 3)
    return table(s, d, "part").select(
        K().alias("name"), scalars.safe_name(F.concat_ws("/", "p_type", "p_name")).alias("safe"), F.format_string("%.3f", "p_retailprice").alias("fixed"),
        scalars.grouped((F.col("p_retailprice") * 1000).cast("bigint")).alias("grouped"), scalars.flip((1 - Z() % 2).cast("int")).alias("flipped"), F.array_join(hot.cast("array<string>"), "").alias("one_hot"),
    )


@query("SELECT p_partkey AS name, list_transform(range(8), lambda i: CASE WHEN i < length(p_name) THEN ROUND(CASE p_name[(i + 1)::BIGINT] WHEN 'a' THEN 1 WHEN 'e' THEN 2 WHEN 'r' THEN 3 ELSE 0 END / 3.0::DOUBLE, 6) ELSE 0.0::DOUBLE END)::VARCHAR AS codes FROM part", "F27")
def character_codes(s: SparkSession, d: str) -> DataFrame:
    codes = F.transform(scalars.char_codes(F.col("p_name"), "aer", 8), lambda x: F.round(x, 6).cast("string"))
    return table(s, d, "part").select(K().alias("name"), F.concat(F.lit("["), F.array_join(codes, ", "), F.lit("]")).alias("codes"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, (epoch(date_trunc('second', ts)) - epoch(TIMESTAMP '2024-01-01'))::BIGINT AS seconds FROM events", "F32")
def time_stamps(s: SparkSession, d: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return table(s, d, "events").select("event_id", scalars.stamp(ts).alias("stamp"), scalars.elapsed(F.lit("2024-01-01").cast("timestamp"), ts).alias("seconds"))


@query("SELECT c_custkey, split_part(k, '-', 1) AS first, left(k, length(k) - 2) AS second, k AS whole FROM (SELECT c_custkey, 'AAAA' || (c_custkey % 7) || '-BB' || (c_custkey % 11) || '-N' AS k FROM customer)", "F7")
def key_layers(s: SparkSession, d: str) -> DataFrame:
    from siftspark.operators import sets

    key = F.concat(F.lit("AAAA"), (F.col("c_custkey") % 7).cast("string"), F.lit("-BB"), (F.col("c_custkey") % 11).cast("string"), F.lit("-N"))
    return table(s, d, "customer").select("c_custkey", *[sets.inchikey_layer(key, n).alias(a) for n, a in ((1, "first"), (2, "second"), (3, "whole"))])


@query("SELECT p_partkey AS row_id, p_name FROM part WHERE p_partkey BETWEEN 10 AND 100 AND (p_partkey - 10) % 3 = 0 UNION ALL SELECT p_partkey, p_name FROM part WHERE p_partkey > (SELECT MAX(p_partkey) FROM part) - 4 UNION ALL SELECT p_partkey, p_name FROM part, (VALUES (5), (5), (7)) v(k) WHERE p_partkey = k", "O13")
def row_slices(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "part").select(K().alias("row_id"), "p_name")
    numbers = s.createDataFrame([(5,), (5,), (7,)], "row_id bigint")
    return joins.pick(rows, 10, 101, 3).unionByName(joins.pick(rows, -4)).unionByName(joins.at_rows(rows, numbers).select("row_id", "p_name"))


@query("SELECT 'name' AS by, MIN(p_partkey) AS row_id FROM part WHERE p_name = (SELECT p_name FROM part WHERE p_partkey = 3) UNION ALL SELECT 'brand', MIN(p_partkey) FROM part WHERE p_brand = (SELECT MIN(p_brand) FROM part) UNION ALL SELECT 'size', MIN(p_partkey) FROM part WHERE p_size = 7", "O14")
def look_ups(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "part").withColumn("row_id", K())
    wanted = {"name": ("p_name", rows.filter(K() == 3).first()["p_name"]), "brand": ("p_brand", rows.agg(F.min("p_brand")).first()[0]), "size": ("p_size", 7)}
    found = [joins.look_up(rows, c, v).select(F.lit(k).alias("by"), "row_id") for k, (c, v) in wanted.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("SELECT l_orderkey AS name, l_linenumber::BIGINT AS n_rows, (ROW_NUMBER() OVER (ORDER BY l_orderkey, l_linenumber) - 1)::BIGINT AS place FROM lineitem", "O12 W4")
def numbered_rows(s: SparkSession, d: str) -> DataFrame:
    from siftspark.operators.ordering import numbered

    return numbered(table(s, d, "lineitem").select(F.col("l_orderkey").alias("name"), F.col("l_linenumber").cast("bigint").alias("n_rows")), ["name", "n_rows"], "place")


@query("SELECT p_partkey, ROW_NUMBER() OVER (ORDER BY ('0x' || substr(md5('5:' || p_partkey), 1, 13))::BIGINT, p_partkey) - 1 AS place FROM part", "O12")
def shuffled_rows(s: SparkSession, d: str) -> DataFrame:
    """The rows in a random order."""
    from siftspark.operators.ordering import numbered

    part = table(s, d, "part").select("p_partkey")
    return numbered(part, [sampling.shuffled(5, "p_partkey"), K()], "place").select("p_partkey", "place")
