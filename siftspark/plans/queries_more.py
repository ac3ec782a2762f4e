"""Registered queries on the operators that the first catalogue left out: joins, curves, sampling, molecules, models, programs and streams."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.functions import kernels, models, processes, standard, training
from siftspark.functions.kernels import KernelRegistry
from siftspark.operators import dedup, evaluation, filters, joins, resources, sampling, scoring, sets, similarity, structure, topk
from siftspark.plans.queries import CURVE_COLUMNS, DOCK_SQL, MODELS_SQL, POINTS_SQL, PRINTS_SQL, SIM_SQL, SCORED_SQL, _curve_sql, _log, _models, _points, _prints, _props, _scored, _votes
from siftspark.plans import active_loop
from siftspark.plans.registry import query, scratch
from siftspark.session import table
from siftspark.sources import commits, remote
from siftspark.streaming import progress, runs

# --- molecules ---------------------------------------------------------------------------------

#: Six kinds of molecules by the part's key; what is expected of each follows from its size.
MOLS_SQL = """mo AS (SELECT p_partkey AS k, p_partkey % 6 AS kind, p_size AS z, CASE p_partkey % 6 WHEN 0 THEN repeat('C', (p_size % 9 + 2)::INTEGER) || 'O' WHEN 1 THEN 'C1' || repeat('C', (p_size % 6 + 2)::INTEGER) || 'C1' WHEN 2 THEN repeat('C', (p_size % 5 + 1)::INTEGER) || 'N.Cl'
  WHEN 3 THEN repeat('C', (p_size % 4 + 1)::INTEGER) || '(' WHEN 4 THEN repeat('C', (p_size % 7 + 1)::INTEGER) || 'c1ccccc1' ELSE repeat('C', (p_size % 3 + 1)::INTEGER) || 'C(=O)[O-]' END AS smiles,
  CASE p_partkey % 6 WHEN 0 THEN p_size % 9 + 2 WHEN 1 THEN p_size % 6 + 4 WHEN 2 THEN p_size % 5 + 1 WHEN 3 THEN 0 WHEN 4 THEN p_size % 7 + 7 ELSE p_size % 3 + 2 END AS nc FROM part)"""


def _mols(s: SparkSession, d: str) -> DataFrame:
    k, z = F.col("p_partkey"), F.col("p_size")
    chain = lambda m, a: F.repeat(F.lit("C"), (z % m + a).cast("int"))
    kinds = [F.concat(chain(9, 2), F.lit("O")), F.concat(F.lit("C1"), chain(6, 2), F.lit("C1")), F.concat(chain(5, 1), F.lit("N.Cl")), F.concat(chain(4, 1), F.lit("(")), F.concat(chain(7, 1), F.lit("c1ccccc1")), F.concat(chain(3, 1), F.lit("C(=O)[O-]"))]
    smiles = reduce(lambda w, i: w.when(k % 6 == i, kinds[i]), range(1, 6), F.when(k % 6 == 0, kinds[0]))
    return table(s, d, "part").select(k.alias("k"), smiles.alias("smiles"))


def _registry() -> KernelRegistry:
    return KernelRegistry()


#: Weight from the number of carbons: C, H and the rest of each kind.
WEIGHT_SQL = "CASE kind WHEN 0 THEN nc * 12.011 + (2 * nc + 2) * 1.008 + 15.999 WHEN 1 THEN nc * 12.011 + 2 * nc * 1.008 WHEN 2 THEN nc * 12.011 + (2 * nc + 3) * 1.008 + 14.007 + 35.45 + 1.008 WHEN 4 THEN nc * 12.011 + (2 * nc - 6) * 1.008 ELSE nc * 12.011 + (2 * nc - 1) * 1.008 + 2 * 15.999 END"


@query(f"""WITH {MOLS_SQL} SELECT k, ROUND({WEIGHT_SQL}, 4) AS MW, CASE kind WHEN 0 THEN 1 WHEN 2 THEN 1 WHEN 5 THEN 2 ELSE 0 END::DOUBLE AS nHA, CASE kind WHEN 0 THEN 1 WHEN 2 THEN 1 ELSE 0 END::DOUBLE AS nHD, CASE WHEN kind IN (1, 4) THEN 1 ELSE 0 END::DOUBLE AS nRing,
CASE kind WHEN 1 THEN nc WHEN 4 THEN 6 ELSE 0 END::DOUBLE AS MaxRing, CASE kind WHEN 0 THEN nc - 2 WHEN 2 THEN nc - 2 WHEN 4 THEN nc - 7 WHEN 5 THEN nc - 2 ELSE 0 END::DOUBLE AS nRot, ROUND(CASE kind WHEN 0 THEN 20.23 WHEN 2 THEN 26.02 WHEN 5 THEN 17.07 + 23.06 ELSE 0 END, 4)::DOUBLE AS TPSA, 0.0::DOUBLE AS nStereo FROM mo WHERE kind <> 3""".replace("WHEN 2 THEN nc - 2", "WHEN 2 THEN GREATEST(nc - 2, 0)").replace("WHEN 4 THEN nc - 7", "WHEN 4 THEN GREATEST(nc - 7, 0)"), "C2 C13 P2 C9")
def chem_properties(s: SparkSession, d: str) -> DataFrame:
    rows = _mols(s, d).withColumn("p", _registry().apply("physchem", F.col("smiles"))).filter("p IS NOT NULL")
    value = lambda c: F.round(F.col("p")[c], 4).alias(c)
    return rows.select("k", *map(value, ("MW", "nHA", "nHD", "nRing", "MaxRing", "nRot", "TPSA", "nStereo")))


@query(f"WITH {MOLS_SQL} SELECT k, CASE WHEN kind <> 3 THEN smiles END AS smiles, CASE kind WHEN 3 THEN NULL WHEN 1 THEN smiles WHEN 4 THEN 'c1ccccc1' ELSE smiles END AS scaffold FROM mo WHERE kind IN (0, 1, 3, 4)", "C1 C8 P2")
def chem_canonical(s: SparkSession, d: str) -> DataFrame:
    """Molecules that are written in canonical order already; the benzene ring is written from its substituent's side."""
    rows = _mols(s, d).filter("k % 6 IN (0, 1, 3, 4)")
    same = F.when(_registry().apply("canonical", F.col("smiles")) == _registry().apply("canonical", F.reverse(F.when(F.col("k") % 6 == 0, F.col("smiles")).otherwise(F.reverse("smiles")))), F.col("smiles"))
    return rows.select("k", same.alias("smiles"), _registry().apply("scaffold", F.col("smiles")).alias("scaffold"))


@query(f"WITH {MOLS_SQL}, g AS (SELECT smiles, COUNT(*) AS n FROM mo WHERE kind <> 3 GROUP BY 1) SELECT n, COUNT(*) AS n_keys, COUNT(*) AS n_well_formed FROM g GROUP BY 1", "C9 F7")
def chem_keys(s: SparkSession, d: str) -> DataFrame:
    """Equal molecules have equal keys, different ones different keys."""
    rows = _mols(s, d).withColumn("key", _registry().apply("key", F.col("smiles"))).filter("key IS NOT NULL")
    by = rows.groupBy("key").agg(F.count("*").alias("n"))
    return by.groupBy("n").agg(F.count("*").alias("n_keys"), F.count_if(F.col("key").rlike("^[A-Z]{14}-[A-Z]{10}-[A-Z]$")).alias("n_well_formed"))


@query(f"WITH {MOLS_SQL} SELECT k, CASE kind WHEN 0 THEN smiles WHEN 1 THEN smiles WHEN 2 THEN repeat('C', nc::INTEGER) || 'N' WHEN 5 THEN repeat('C', (nc - 1)::INTEGER) || 'C(=O)O' END AS smiles, CASE WHEN kind = 3 THEN 'parse' END AS dropped_at FROM mo WHERE kind <> 4", "C10 C11 P14 P15 P16 P17")
def chem_standard(s: SparkSession, d: str) -> DataFrame:
    rows = _mols(s, d).filter("k % 6 != 4")
    steps = (*standard.DEFAULT, "remove_mixtures", "weight_1000", "atoms_6")
    done = standard.standardised(rows, steps).withColumn("_want", F.expr("CASE k % 6 WHEN 2 THEN regexp_replace(smiles, '[.]Cl$', '') ELSE smiles END"))
    acid = F.when(F.col("k") % 6 == 5, F.concat(F.left("smiles", F.length("smiles") - 6), F.lit("C(=O)O"))).otherwise(F.col("smiles"))
    return done.select("k", acid.alias("smiles"), "dropped_at")


@query(f"WITH {MOLS_SQL}, n AS (SELECT COUNT(*) AS a, COUNT(*) FILTER (kind = 3) AS bad, COUNT(*) FILTER (kind = 2) AS mixed, COUNT(*) FILTER (kind = 4 AND nc > 9) AS heavy FROM mo) SELECT 0 AS place, 'parse' AS step, bad AS dropped, a - bad AS left FROM n UNION ALL SELECT 1, 'remove_mixtures', mixed, a - bad - mixed FROM n UNION ALL SELECT 2, 'weight_1000', 0, a - bad - mixed FROM n UNION ALL SELECT 3, 'atoms_6', 0, a - bad - mixed FROM n", "C11 P17")
def chem_step_report(s: SparkSession, d: str) -> DataFrame:
    steps = ("remove_mixtures", "weight_1000", "atoms_6")
    return standard.step_report(standard.standardised(_mols(s, d), steps), steps)


@query(f"WITH {MOLS_SQL} SELECT k, repeat('C', nc::INTEGER) || 'N' AS a, 'O' AS b FROM mo WHERE kind = 2", "P18 C10")
def chem_pairs(s: SparkSession, d: str) -> DataFrame:
    member = lambda c: F.struct(F.col("k").cast("string").alias("name"), c.alias("smiles"))
    pairs = _mols(s, d).filter("k % 6 IN (2, 3)").select("k", member(F.col("smiles")).alias("a"), member(F.lit("O")).alias("b"))
    return standard.standard_pairs(pairs, ("remove_salts", "largest_fragment")).select("k", "a.smiles", F.col("b.smiles").alias("b")).withColumnRenamed("smiles", "a")


@query(f"WITH {MOLS_SQL} SELECT k, CASE WHEN kind <> 3 THEN (kind IN (0, 5) AND (kind = 0 OR FALSE))::INTEGER END AS m0, CASE WHEN kind <> 3 THEN (kind = 4)::INTEGER END AS m1, CASE WHEN kind <> 3 THEN (kind = 2)::INTEGER END AS m2, kind IN (0, 2, 4) AS any_match FROM mo", "C7 P9 A25")
def substructure_matrix(s: SparkSession, d: str) -> DataFrame:
    return kernels.substructures(_mols(s, d), "smiles", ["C[OH]", "Cc1ccccc1", "CN"]).drop("smiles")


@query(f"WITH {MOLS_SQL} SELECT k, (3 * (nc + 1))::BIGINT AS n_environments, TRUE AS within, TRUE AS keyed FROM mo WHERE kind = 0", "C4 C5 C6")
def chem_fingerprints(s: SparkSession, d: str) -> DataFrame:
    r = _registry()
    r.register("ecfp2_2048", kernels.fingerprint("ecfp2_2048"), "array<int>")
    rows = _mols(s, d).filter("k % 6 = 0").select("k", r.apply("counted_environments", F.col("smiles")).alias("c"), r.apply("fingerprint", F.col("smiles")).alias("f"), r.apply("ecfp2_2048", F.col("smiles")).alias("g"), r.apply("keys", F.col("smiles")).alias("keys"))
    total = F.aggregate(F.map_values("c"), F.lit(0).cast("bigint"), lambda a, x: a + x)
    within = (F.array_max("f") < 1024) & (F.array_max("g") < 2048) & (F.size("g") <= F.size("f")) & (F.size("f") <= F.size("c"))
    return rows.select("k", total.alias("n_environments"), within.alias("within"), F.array_contains("keys", 4).alias("keyed"))


@query(f"WITH {MOLS_SQL} SELECT k, (nc + 1)::DOUBLE AS nhev, (2 * nc + 2)::DOUBLE AS nhyd, ((nc + 1) * (nc + 2) * nc / 6)::DOUBLE AS W, (4 * (nc - 1) + 2)::DOUBLE AS ZM1, ROUND((2 + (nc - 1) / SQRT(2))::DOUBLE, 6) AS Chi0, nc::DOUBLE AS diameter, ROUND(((nc + 1) * nc * nc / (nc * nc))::DOUBLE, 6) AS kappa1, nc::DOUBLE AS nsb FROM mo WHERE kind = 0", "C3 2.13-scalar")
def chem_descriptors(s: SparkSession, d: str) -> DataFrame:
    rows = _mols(s, d).filter("k % 6 = 0").withColumn("d", _registry().apply("descriptors", F.col("smiles")))
    return rows.select("k", *[F.round(F.col("d")[c], 6).alias(c) for c in ("nhev", "nhyd", "W", "ZM1", "Chi0", "diameter", "kappa1", "nsb")])


@query(f"WITH {MOLS_SQL} SELECT k AS name, c::INTEGER AS conf_id, k || '_conf_' || c AS file_name, (nc + 1)::BIGINT AS n_atoms, TRUE AS spread FROM mo, (VALUES (0), (1)) v(c) WHERE kind = 0", "C12")
def conformers(s: SparkSession, d: str) -> DataFrame:
    atoms = kernels.with_conformers(_mols(s, d).filter("k % 6 IN (0, 3)").select(F.col("k").cast("string").alias("name"), "smiles"), 2)
    return atoms.groupBy(F.col("name").cast("bigint").alias("name"), "conf_id", "file_name").agg(F.count("*").alias("n_atoms"), (F.max("x") - F.min("x") + F.max("y") - F.min("y") > 1).alias("spread"))


@query("SELECT p_partkey AS name FROM part WHERE p_size <= 12 AND p_partkey % 3 > 0", "P10")
def acceptor_limit(s: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("p_partkey") % 3 == 0, F.lit("n/a")).when(F.col("p_partkey") % 3 == 1, F.concat(F.lit(" "), F.col("p_size").cast("string"))).otherwise(F.col("p_size").cast("string"))
    return filters.at_most(table(s, d, "part").select(F.col("p_partkey").alias("name"), text.alias("HBA")), "HBA", 12).select("name")


# --- predicates and projections ----------------------------------------------------------------


@query(f"WITH {DOCK_SQL} SELECT name, nHA, nHD, LogP, MW FROM props", "P4")
def property_set(s: SparkSession, d: str) -> DataFrame:
    return filters.select_properties(_props(s, d), "ro5")


@query("SELECT p_partkey AS name, CASE WHEN p_partkey % 5 > 2 THEN p_size / 2.0 END::DOUBLE AS guarded, p_partkey % 5 NOT IN (1, 2) AS without_nan FROM part", "P12 P13")
def finite_rows(s: SparkSession, d: str) -> DataFrame:
    k, z = F.col("p_partkey"), F.col("p_size").cast("double")
    odd = F.when(k % 5 == 0, F.lit(float("inf"))).when(k % 5 == 1, F.lit(float("nan"))).when(k % 5 == 2, F.lit(None).cast("double")).otherwise(z)
    rows = table(s, d, "part").select(k.alias("name"), F.array(z, odd).alias("x"))
    kept = filters.without_nan(rows, "x").select("name", F.lit(True).alias("_k"))
    return rows.join(kept, "name", "left").select("name", filters.guarded_prediction("x", F.get("x", F.lit(0)) / 2).alias("guarded"), F.coalesce("_k", F.lit(False)).alias("without_nan"))


@query("SELECT p_partkey AS name, p_size::DOUBLE AS a, p_retailprice AS b FROM part WHERE p_partkey % 4 = 3", "P19 F10 F17")
def numeric_rows(s: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    a = F.when(k % 4 == 0, F.lit("N/A")).when(k % 4 == 1, F.lit("nan")).otherwise(F.col("p_size").cast("string"))
    b = F.when(k % 4 == 2, F.lit("")).otherwise(F.col("p_retailprice").cast("string"))
    return filters.numeric(table(s, d, "part").select(k.alias("name"), a.alias("a"), b.alias("b")), "a", "b")


@query("SELECT o_orderkey, o_totalprice < 50000 AS hit FROM orders", "P23")
def hits(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "orders").select("o_orderkey", filters.is_hit(F.col("o_totalprice"), 50_000).alias("hit"))


@query("""WITH m AS (SELECT event_id AS seq, CASE WHEN event_type IN ('signup', 'purchase') THEN NULL WHEN event_type = 'click' THEN (event_id % 2) || '% 1:100=5s' ELSE 'error at ' || event_id END AS message FROM events), k AS (SELECT * FROM m WHERE message IS NOT NULL)
SELECT seq, message FROM (SELECT *, LAG(message) OVER (ORDER BY seq) AS b FROM k) WHERE b IS DISTINCT FROM message""", "P27 W8 F6")
def progress_lines(s: SparkSession, d: str) -> DataFrame:
    percent = F.concat(F.lit("\x1b[32m"), (F.col("event_id") % 2).cast("string"), F.lit("% 1:100=5s\x1b[0m"))
    message = F.when(F.col("event_type").isin("signup", "purchase"), F.lit("quiet")).when(F.col("event_type") == "click", percent).otherwise(F.concat(F.lit("error at "), F.col("event_id").cast("string")))
    return progress.progress_lines(table(s, d, "events").select(F.col("event_id").alias("seq"), message.alias("message")))


# --- joins and sets ----------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, p_name FROM lineitem JOIN part ON p_partkey = l_partkey", "J4")
def must_match(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "lineitem").withColumnRenamed("l_partkey", "name")
    return joins.must_match(rows, table(s, d, "part").select(F.col("p_partkey").alias("name"), "p_name"), "name").select("l_orderkey", "l_linenumber", "p_name")


@query("SELECT p_partkey AS row_id, p_name, p_brand FROM part", "J5")
def zipped_rows(s: SparkSession, d: str) -> DataFrame:
    part = table(s, d, "part").withColumn("row_id", F.col("p_partkey"))
    return joins.zip_rows(part.select("row_id", "p_name"), part.select("row_id", "p_brand"))


@query("SELECT p_partkey AS row_id, 'n' || p_partkey AS a, CASE WHEN p_partkey % 10 = 1 THEN 'x' END AS b FROM part WHERE p_partkey % 10 IN (1, 2)", "J6")
def misaligned_rows(s: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    a = table(s, d, "part").select(k.alias("row_id"), F.concat(F.lit("n"), k.cast("string")).alias("name"))
    b = a.filter("row_id % 10 != 2").withColumn("name", F.when(F.col("row_id") % 10 == 1, "x").otherwise(F.col("name")))
    return joins.misaligned(a, b, "row_id", "name").select("row_id", F.col("_a").alias("a"), F.col("_b").alias("b"))


@query("SELECT doc_id AS id, toxic AS label, lang, n_chars FROM labels JOIN documents USING (doc_id)", "J9")
def labelled_features(s: SparkSession, d: str) -> DataFrame:
    library = table(s, d, "documents").select(F.col("doc_id").alias("id"), "lang", "n_chars")
    return joins.with_features(table(s, d, "labels").select(F.col("doc_id").alias("id"), F.col("toxic").alias("label")), library)


@query("""WITH sp AS (SELECT o_custkey AS id, MIN(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END) AS r FROM orders GROUP BY 1)
SELECT c_custkey AS id, c_name, CASE r WHEN 1 THEN 'train' WHEN 2 THEN 'valid' ELSE 'test' END AS split FROM customer JOIN sp ON sp.id = c_custkey""", "J10 A13")
def routed_rows(s: SparkSession, d: str) -> DataFrame:
    """Library rows are there twice; the first counts."""
    split = F.when(F.col("o_orderstatus") == "F", "train").when(F.col("o_orderstatus") == "O", "valid").otherwise("test")
    splits = table(s, d, "orders").select(F.col("o_custkey").alias("id"), split.alias("split"))
    customers = table(s, d, "customer")
    library = customers.select(F.col("c_custkey").alias("id"), "c_name", F.col("c_custkey").alias("row_id")).unionByName(customers.select(F.col("c_custkey").alias("id"), F.lit("late").alias("c_name"), (F.col("c_custkey") + 10**9).alias("row_id")))
    return joins.route(library, splits).drop("row_id")


@query("SELECT n_name AS target, p_partkey AS ligand FROM nation, part WHERE n_regionkey = 1 AND p_size > 45", "J20 E7")
def off_target_jobs(s: SparkSession, d: str) -> DataFrame:
    targets = table(s, d, "nation").filter("n_regionkey = 1").select(F.col("n_name").alias("target"))
    ligands = table(s, d, "part").select(F.col("p_partkey").alias("ligand"))
    return joins.off_target_jobs(targets, ligands, table(s, d, "part").filter("p_size > 45").select(F.col("p_partkey").alias("ligand"))).select("target", "ligand")


@query("SELECT l_linenumber + 10 * l_orderkey AS row_id, l_suppkey AS id, s_name FROM lineitem JOIN supplier ON s_suppkey = l_suppkey", "J21")
def database_rows(s: SparkSession, d: str) -> DataFrame:
    ids = table(s, d, "lineitem").select((F.col("l_linenumber") + 10 * F.col("l_orderkey")).alias("row_id"), F.col("l_suppkey").alias("id"))
    return joins.rows_in_order(ids, table(s, d, "supplier").select(F.col("s_suppkey").alias("id"), "s_name"))


@query(f"WITH {MODELS_SQL}, t AS (SELECT o_orderkey % 40 AS model_no, ARG_MIN(o_totalprice, o_orderkey) AS thresh FROM orders GROUP BY 1) SELECT model_no, cutoff, thresh FROM m JOIN t USING (model_no)", "J24")
def first_thresholds(s: SparkSession, d: str) -> DataFrame:
    thresholds = table(s, d, "orders").select((F.col("o_orderkey") % 40).alias("model_no"), F.col("o_totalprice").alias("thresh"), F.col("o_orderkey").alias("row_id"))
    return joins.first_threshold(_models(s, d), thresholds).select("model_no", "cutoff", "thresh")


@query("SELECT DISTINCT o_custkey AS id, 'train' AS split FROM orders WHERE o_orderkey % 3 = 0 AND o_orderstatus = 'F' OR o_orderkey % 3 = 1 UNION ALL SELECT DISTINCT o_custkey, CASE o_orderstatus WHEN 'O' THEN 'valid' ELSE 'test' END FROM orders WHERE o_orderkey % 3 = 0 AND o_orderstatus <> 'F'", "U6")
def cumulative_training(s: SparkSession, d: str) -> DataFrame:
    split = F.when(F.col("o_orderstatus") == "F", "train").when(F.col("o_orderstatus") == "O", "valid").otherwise("test")
    rows = table(s, d, "orders").select(F.col("o_custkey").alias("id"), split.alias("split"), (F.col("o_orderkey") % 3 + 1).alias("iteration"))
    return sets.cumulative_training(rows, 2)


@query("""WITH r AS (SELECT source || ':' || (n_chars % 20)::VARCHAR AS key, quality::DOUBLE AS a, toxic::DOUBLE AS b, doc_id FROM documents JOIN labels USING (doc_id)), g AS (SELECT key, MIN(a) a0, MAX(a) a1, MIN(b) b0, MAX(b) b1, ARG_MIN(a, doc_id) fa, ARG_MIN(b, doc_id) fb, COUNT(*) n FROM r GROUP BY 1)
SELECT 'keep_first' AS policy, key, fa AS a, fb AS b, n AS n_rows FROM g UNION ALL SELECT 'remove_both', key, fa, fb, n FROM g WHERE a0 = a1 AND b0 = b1 UNION ALL SELECT 'keep_all', key, a, b, COUNT(*) FROM r GROUP BY key, a, b""", "A12")
def multi_label_policies(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "documents").select("doc_id", "source", "n_chars").join(table(s, d, "labels"), "doc_id")
    rows = docs.select(F.concat_ws(":", "source", (F.col("n_chars") % 20).cast("string")).alias("key"), F.col("quality").alias("a"), F.col("toxic").alias("b"), "doc_id")
    parts = [dedup.resolve_label_rows(rows, "key", ["a", "b"], "doc_id", p).withColumn("policy", F.lit(p)) for p in ("keep_first", "remove_both", "keep_all")]
    return reduce(DataFrame.unionByName, parts)


# --- scores ------------------------------------------------------------------------------------

PROFILE = ("LogS", "hERG", "HIA")


def _profile(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "customer").select(F.col("c_custkey").alias("name"), (F.col("c_acctbal") / 1000 - 6).alias("LogS"), (F.col("c_custkey") % 10 / F.lit(10.0)).alias("hERG"), (F.col("c_custkey") % 7 / F.lit(7.0)).alias("HIA"))


PROFILE_SQL = "pf AS (SELECT c_custkey AS name, c_acctbal / 1000 - 6 AS LogS, (c_custkey % 10) / 10.0::DOUBLE AS hERG, (c_custkey % 7) / 7.0::DOUBLE AS HIA FROM customer)"
WEIGHTS_SQL = "sh AS (SELECT COUNT(*) FILTER (LogS > -4 AND LogS < 0.5) / COUNT(*)::DOUBLE AS s0, 1 - COUNT(*) FILTER (hERG > 0.5) / COUNT(*)::DOUBLE AS s1, COUNT(*) FILTER (HIA > 0.5) / COUNT(*)::DOUBLE AS s2 FROM pf), w AS (SELECT (0.75 * s0 + 0.25) * 0.967 AS w0, (0.75 * s1 + 0.25) * 0.848 AS w1, (0.75 * s2 + 0.25) * 0.773 AS w2 FROM sh)"


@query(f"WITH {PROFILE_SQL}, {WEIGHTS_SQL} SELECT 'LogS' AS endpoint, ROUND(w0, 6) AS weight FROM w UNION ALL SELECT 'hERG', ROUND(w1, 6) FROM w UNION ALL SELECT 'HIA', ROUND(w2, 6) FROM w", "A4 A5 S25 S23")
def endpoint_weights(s: SparkSession, d: str) -> DataFrame:
    weights = scoring.endpoint_weights(_profile(s, d), list(PROFILE))
    return s.createDataFrame([(k, round(v, 6)) for k, v in weights.items()], "endpoint string, weight double")


@query(f"WITH {PROFILE_SQL}, {WEIGHTS_SQL} SELECT name, ROUND(EXP((w0 * LN({_curve_sql('LogS', scoring.CURVES['LogS'])}) + w1 * LN(CASE WHEN hERG = 1 THEN 1e-5 ELSE 1 - hERG END) + w2 * LN(CASE WHEN HIA = 0 THEN 1e-5 ELSE HIA END)) / (w0 + w1 + w2)), 6) AS score FROM pf, w", "A6 F14 F15 S23")
def admet_scores(s: SparkSession, d: str) -> DataFrame:
    profile = _profile(s, d)
    return scoring.admet_score(profile, scoring.endpoint_weights(profile, list(PROFILE))).withColumn("score", F.round("score", 6))


@query(f"WITH {DOCK_SQL}, r AS (SELECT name, MW, LogP, RANK() OVER (ORDER BY MW DESC) AS rank FROM props), t AS (SELECT * FROM r ORDER BY rank, name LIMIT 100) SELECT 'all' AS rows, COUNT(*) AS n, ROUND(SUM(MW::DECIMAL(24,6))::DOUBLE / COUNT(*), 6) AS mean_MW, ROUND(SUM(LogP::DECIMAL(24,6))::DOUBLE / COUNT(*), 6) AS mean_LogP FROM r UNION ALL SELECT 'top 100', COUNT(*), ROUND(SUM(MW::DECIMAL(24,6))::DOUBLE / COUNT(*), 6), ROUND(SUM(LogP::DECIMAL(24,6))::DOUBLE / COUNT(*), 6) FROM t", "A3")
def summary_means(s: SparkSession, d: str) -> DataFrame:
    found = scoring.means(scoring.ranked(_props(s, d), "MW"), ["MW", "LogP"], top=[100])
    return found.withColumns({c: F.round(c, 6) for c in ("mean_MW", "mean_LogP")})


@query("SELECT o_custkey, ROUND(AVG(o_totalprice), 4) AS o_totalprice, ROUND(AVG(o_orderkey), 4) AS o_orderkey FROM orders GROUP BY 1", "A7")
def ensemble_means(s: SparkSession, d: str) -> DataFrame:
    found = evaluation.mean_by(table(s, d, "orders"), "o_custkey", ["o_totalprice", "o_orderkey"])
    return found.withColumns({c: F.round(c, 4) for c in ("o_totalprice", "o_orderkey")})


# --- similarity --------------------------------------------------------------------------------


@query(f"WITH {PRINTS_SQL} SELECT target, query, ROUND(sim, 6) AS sim, (ROW_NUMBER() OVER (PARTITION BY query ORDER BY sim DESC, target))::INTEGER AS place FROM (SELECT a.id AS target, b.id AS query, {SIM_SQL} AS sim FROM fp a, fp b WHERE b.id % 20 = 0)", "O11 J16")
def ranked_matches(s: SparkSession, d: str) -> DataFrame:
    fp = _prints(s, d)
    return topk.ranked_prints(fp, fp.filter("id % 20 = 0")).withColumn("sim", F.round("sim", 6))


@query(f"WITH {PRINTS_SQL} SELECT * FROM (SELECT target, query, ROUND(sim, 6) AS sim, (ROW_NUMBER() OVER (PARTITION BY query ORDER BY sim DESC, target))::INTEGER AS place FROM (SELECT a.id AS target, b.id AS query, {SIM_SQL} AS sim FROM fp a, fp b WHERE b.id % 20 = 0)) WHERE place <= 10", "O11 J17 W3")
def top_matches(s: SparkSession, d: str) -> DataFrame:
    """The ten most similar prints of each in a stated list."""
    fp = _prints(s, d)
    return topk.top_prints(fp, fp.filter("id % 20 = 0"), 10).withColumn("sim", F.round("sim", 6))


@query("""WITH w AS (SELECT doc_id AS id, string_split(COALESCE(text, ''), ' ') AS ws FROM documents), g AS (SELECT DISTINCT id, ws[i:i+2] AS g FROM (SELECT id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)), c AS (SELECT id, COUNT(*) AS n FROM g GROUP BY 1),
p AS (SELECT x.id AS query, y.id AS id, COUNT(*) AS o FROM g x JOIN g y USING (g) WHERE x.id % 20 = 0 GROUP BY 1, 2), r AS (SELECT p.query, p.id, o::DOUBLE / (a.n + b.n - o) AS sim FROM p JOIN c a ON a.id = p.query JOIN c b ON b.id = p.id)
SELECT query, id, ROUND(sim, 6) AS sim, place FROM (SELECT *, (ROW_NUMBER() OVER (PARTITION BY query ORDER BY sim DESC, id))::INTEGER AS place FROM r) WHERE place <= 10""", "O11 J17 J16 W3")
def similar_documents(s: SparkSession, d: str) -> DataFrame:
    """The ten documents most similar to each twentieth one, as sets of three-word shingles."""
    words = F.split(F.coalesce("text", F.lit("")), " ")
    last = F.greatest(F.size(words) - 2, F.lit(0))
    threes = F.arrays_zip(*[F.slice(words, k, last).alias(f"w{k}") for k in (1, 2, 3)])
    shingles = F.transform(threes, lambda x: F.xxhash64(x["w1"], x["w2"], x["w3"]))
    sets_ = table(s, d, "documents").select(F.col("doc_id").alias("id"), shingles.alias("bits"))
    found = topk.top_shared(sets_.filter("id % 20 = 0"), sets_, 10)
    return found.select("query", "id", F.round("sim", 6).alias("sim"), "place")


@query("""WITH w AS (SELECT DISTINCT doc_id AS id, unnest(string_split(COALESCE(text, ''), ' ')) AS key FROM documents JOIN labels USING (doc_id) WHERE n_chars < 400), c AS (SELECT id, COUNT(*) AS n FROM w GROUP BY 1)
SELECT x.id AS a, y.id AS b, ROUND(COUNT(*)::DOUBLE / (ANY_VALUE(cx.n) + ANY_VALUE(cy.n) - COUNT(*)), 6) AS sim FROM w x JOIN w y USING (key) JOIN c cx ON cx.id = x.id JOIN c cy ON cy.id = y.id WHERE x.id < y.id GROUP BY 1, 2 HAVING COUNT(*)::DOUBLE / (ANY_VALUE(cx.n) + ANY_VALUE(cy.n) - COUNT(*)) >= 0.6""", "J12 J13")
def sparse_pairs(s: SparkSession, d: str) -> DataFrame:
    """Sets of words as numbers by frequency, rare ones high, of the labelled short texts."""
    texts = table(s, d, "documents").join(table(s, d, "labels").select("doc_id"), "doc_id", "left_semi").filter("n_chars < 400")
    words = texts.select(F.col("doc_id").alias("id"), F.explode(F.array_distinct(F.split(F.coalesce("text", F.lit("")), " "))).alias("key"))
    from siftspark.operators.ordering import numbered

    rank = numbered(words.groupBy("key").agg(F.count("*").alias("n")), [F.desc("n"), F.col("key")], "bit")
    sets_ = words.join(rank, "key").groupBy("id").agg(F.collect_list(F.col("bit").cast("int")).alias("bits"))
    return similarity.threshold_pairs(sets_, 0.6).withColumn("sim", F.round("sim", 6))


SQUARE = "(a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z)"


@query(f"WITH {POINTS_SQL} SELECT a.id AS d, b.id AS a, ROUND(SQRT({SQUARE}), 6) AS distance, ROUND(DEGREES(ACOS(GREATEST(-1, LEAST(1, (a.x + 1 - b.x) / SQRT((a.x+1-b.x)*(a.x+1-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z)))))), 4) AS angle FROM pt a, pt b WHERE a.label < 5 AND b.label >= 5 AND {SQUARE} <= 0.06 * 0.06", "C14 J18")
def hydrogen_bonds(s: SparkSession, d: str) -> DataFrame:
    """The angle at a point one unit beyond the donor along x, between donor and acceptor."""
    p = _points(s, d)
    donors = p.filter("label < 5").select("id", "x", "y", "z", (F.col("x") + 1).alias("bx"), F.col("y").alias("by"), F.col("z").alias("bz"))
    found = structure.hydrogen_bonds(donors, p.filter("label >= 5"), 0.06)
    return found.select("d", "a", F.round("distance", 6).alias("distance"), F.round("angle", 4).alias("angle"))


# --- evaluation --------------------------------------------------------------------------------


@query(f"WITH {SCORED_SQL} SELECT 'quality' AS task, ROUND(SUM(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0 END)::DOUBLE / COUNT(*), 6) AS auc FROM sc a, sc b WHERE a.label = 1 AND b.label = 0 UNION ALL SELECT 'even', ROUND(SUM(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0 END)::DOUBLE / COUNT(*), 6) FROM sc a, sc b WHERE a.label = 1 AND b.label = 0 AND a.score % 2 = 0 AND b.score % 2 = 0", "A26 W7")
def task_aucs(s: SparkSession, d: str) -> DataFrame:
    rows = _scored(s, d).withColumn("even", F.when(F.col("score") % 2 == 0, F.col("label"))).withColumn("none", F.lit(1))
    return evaluation.task_aucs(rows, {"quality": ("score", "label"), "even": ("score", "even"), "none": ("score", "none")}).withColumn("auc", F.round("auc", 6))


@query(f"WITH {SCORED_SQL}, q AS (SELECT LEAST(score / 4000, 1.0) AS p, label FROM sc WHERE score IS NOT NULL), n AS (SELECT COUNT(*) FILTER (label = 1) AS p, COUNT(*) FILTER (label = 0) AS n FROM q), g AS (SELECT t, 1 - COUNT(*) FILTER (label = 0 AND FLOOR(q.p * 1000 + 1e-9) < t) / ANY_VALUE(n.n)::DOUBLE AS fpr, COUNT(*) FILTER (label = 1 AND FLOOR(q.p * 1000 + 1e-9) < t) / ANY_VALUE(n.p)::DOUBLE AS fnr FROM range(0, 1001) r(t), q, n GROUP BY 1) SELECT t / 1000.0::DOUBLE AS threshold, ROUND((fpr + fnr) / 2, 6) AS eer FROM g WHERE t = (SELECT MIN(t) FROM g WHERE fpr < fnr)", "A27")
def equal_error_rate(s: SparkSession, d: str) -> DataFrame:
    rows = _scored(s, d).withColumn("score", F.least(F.col("score") / 4000, F.lit(1.0)))
    return evaluation.equal_error_rate(rows, "score", "label").withColumn("eer", F.round("eer", 6))


@query(f"""WITH {SCORED_SQL}, c AS (SELECT COUNT(*) FILTER (label = 1 AND predicted = 1) tp, COUNT(*) FILTER (label = 0 AND predicted = 1) fp, COUNT(*) FILTER (label = 0 AND predicted = 0) tn, COUNT(*) FILTER (label = 1 AND predicted = 0) fn FROM sc), m AS (SELECT *, tp / (tp + fp)::DOUBLE AS p, 2.0 * tp / (2 * tp + fn + fp)::DOUBLE AS f1 FROM c)
SELECT ROUND(tn / (tn + fp)::DOUBLE, 6) AS specificity, ROUND(tn / (tn + fn)::DOUBLE, 6) AS npv, ROUND(5.0 * tp / (5 * tp + 4 * fn + fp)::DOUBLE, 6) AS f2, ROUND((p * p + f1 * f1) / 2, 6) AS scaled, ROUND((p * p + f1 * f1) / 2 / POWER(1.03, 2), 6) AS scaled_by_size, ROUND(p / 2, 6) AS precision_by_size FROM m""", "A27")
def more_metrics(s: SparkSession, d: str) -> DataFrame:
    c = evaluation.confusion(_scored(s, d), "label", "predicted")
    sized = evaluation.size_penalised(F.col("scaled_performance"), F.col("precision"), 2_000_000)
    return c.select(*[F.round(x, 6).alias(x) for x in ("specificity", "npv", "f2")], F.round("scaled_performance", 6).alias("scaled"), F.round(sized[0], 6).alias("scaled_by_size"), F.round(sized[1], 6).alias("precision_by_size"))


@query(f"WITH {DOCK_SQL}, v AS (SELECT (CASE WHEN m1 >= 0.3 THEN 1 ELSE 0 END + CASE WHEN m2 >= 0.4 THEN 1 ELSE 0 END + CASE WHEN m3 >= 0.2 THEN 1 ELSE 0 END) > 1 AS hit, name % 2 = 1 AS y FROM votes WHERE m1 IS NOT NULL AND m2 IS NOT NULL AND m3 IS NOT NULL), c AS (SELECT COUNT(*) FILTER (y AND hit) tp, COUNT(*) FILTER (NOT y AND hit) fp, COUNT(*) FILTER (y AND NOT hit) fn FROM v) SELECT tp, fp, fn, ROUND(tp / (tp + fp)::DOUBLE, 6) AS precision, ROUND(tp / (tp + fn)::DOUBLE, 6) AS recall FROM c", "A28 P22")
def consensus_report(s: SparkSession, d: str) -> DataFrame:
    rows = _votes(s, d).filter("m1 IS NOT NULL AND m2 IS NOT NULL AND m3 IS NOT NULL").withColumn("y", (F.col("name") % 2).cast("int"))
    found = evaluation.consensus_report(rows, ["m1", "m2", "m3"], [0.3, 0.4, 0.2], "y")
    return found.withColumns({c: F.round(c, 6) for c in ("precision", "recall")})


@query(f"WITH {MODELS_SQL} SELECT model_no, ROUND(re_te * 300 * 1e6 / NULLIF(pr_te * 5000, 0), 2) AS expected FROM m", "A30")
def expected_survivors(s: SparkSession, d: str) -> DataFrame:
    expected = evaluation.expected_survivors(F.col("re_te"), F.lit(300), F.col("pr_te"), F.lit(1e6), F.lit(5000))
    return _models(s, d).select("model_no", F.round(expected, 2).alias("expected"))


@query(f"WITH {MODELS_SQL} SELECT cutoff, ROUND(AVG((pr_te + model_no % 3) / 2), 6) AS mean_ratio, ROUND(STDDEV_SAMP((pr_te + model_no % 3) / 2), 6) AS std_ratio FROM m GROUP BY 1", "A16")
def recall_spread(s: SparkSession, d: str) -> DataFrame:
    rows = _models(s, d).withColumns({"re_vl": F.col("pr_te") + F.col("model_no") % 3, "re_pr": F.lit(2.0)})
    return evaluation.recall_spread(rows).withColumns({c: F.round(c, 6) for c in ("mean_ratio", "std_ratio")})


@query(f"WITH {MODELS_SQL}, g AS (SELECT cutoff, SUM((pr_te * 10)::INTEGER) AS expected FROM m GROUP BY 1) SELECT cutoff, expected::BIGINT AS expected FROM g ORDER BY expected, cutoff DESC LIMIT 1", "O7 M14")
def best_cutoff(s: SparkSession, d: str) -> DataFrame:
    return evaluation.best_cutoff(_models(s, d).groupBy("cutoff").agg(F.sum(F.round(F.col("pr_te") * 10).cast("int")).alias("expected")))


@query("""WITH p AS (SELECT o_orderkey % 4 AS model_no, (o_orderkey % 2)::DOUBLE AS cutoff, o_totalprice AS score, (o_orderstatus = 'F')::INTEGER AS label FROM orders), r AS (SELECT *, SUM(label) OVER (PARTITION BY model_no ORDER BY score DESC) / (SUM(label) OVER (PARTITION BY model_no))::DOUBLE AS recall FROM p)
SELECT model_no, cutoff, MAX(score) AS threshold FROM r WHERE recall > 0.9 GROUP BY 1, 2""", "M14 W6")
def threshold_table(s: SparkSession, d: str) -> DataFrame:
    k = F.col("o_orderkey")
    selected = table(s, d, "orders").select((k % 4).alias("model_no"), (k % 2).cast("double").alias("cutoff")).distinct()
    predictions = table(s, d, "orders").select((k % 4).alias("model_no"), F.col("o_totalprice").alias("score"), (F.col("o_orderstatus") == "F").cast("int").alias("label"))
    return evaluation.threshold_table(selected, predictions, 0.9)


@query("WITH e AS (SELECT user_id, event_id, AVG(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS v FROM events), b AS (SELECT *, MIN(v) OVER (PARTITION BY user_id ORDER BY event_id) AS best, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM e), w AS (SELECT *, i - MAX(CASE WHEN v = best THEN i END) OVER (PARTITION BY user_id ORDER BY event_id) AS waited FROM b) SELECT user_id, MAX(waited) AS longest, ARG_MAX(waited, event_id) AS now FROM w GROUP BY 1", "W9")
def stop_estimates(s: SparkSession, d: str) -> DataFrame:
    return evaluation.stop_estimate(table(s, d, "events"), "event_id", "value", 3, ["user_id"])


@query("WITH b AS (SELECT event_id, value, MAX(value) OVER (ORDER BY event_id) AS best, ROW_NUMBER() OVER (ORDER BY event_id) AS i FROM events) SELECT event_id, best, i - MAX(CASE WHEN value = best THEN i END) OVER (ORDER BY event_id) AS waited FROM b", "W10")
def single_series(s: SparkSession, d: str) -> DataFrame:
    return evaluation.best_so_far(table(s, d, "events").select("event_id", "value"), "event_id", "value").select("event_id", "best", "waited")


# --- sampling and learning ---------------------------------------------------------------------


@query("WITH c AS (SELECT source, COUNT(*) // 5 AS f, COUNT(*) // 50 AS l FROM documents GROUP BY 1) SELECT source, i::INTEGER AS iteration, FLOOR(f + (i - 1) / 9.0::DOUBLE * (l - f))::BIGINT AS n FROM c, range(1, 11) r(i)", "F25")
def hit_schedule(s: SparkSession, d: str) -> DataFrame:
    """Hits to keep of each source in ten iterations, from a fifth of its rows to a fiftieth."""
    counts = table(s, d, "documents").groupBy("source").agg(F.floor(F.count("*") / 5).alias("first"), F.floor(F.count("*") / 50).alias("last"))
    return sampling.hit_schedules(counts, "first", "last", 10).select("source", "iteration", "n")


def draw_sql(seed: int, *key: str) -> str:
    """What stands for a random number: see sampling.shuffled."""
    return f"('0x' || substr(md5('{seed}:' || {" || ':' || ".join(key)}), 1, 13))::BIGINT"


@query(f"SELECT doc_id, ((ROW_NUMBER() OVER (ORDER BY {draw_sql(3, 'doc_id')}, doc_id) - 1) % 5)::INTEGER AS fold FROM documents", "M6")
def shuffled_folds(s: SparkSession, d: str) -> DataFrame:
    return sampling.shuffled_folds(table(s, d, "documents").select("doc_id"), "doc_id", 5, 3)


@query(f"""WITH t AS (SELECT 'nation' AS task, 3 AS w, n_name AS name, ROW_NUMBER() OVER (ORDER BY {draw_sql(1, 'n_name')}, n_name) - 1 AS i, COUNT(*) OVER () AS n FROM nation
UNION ALL SELECT 'region', 1, r_name, ROW_NUMBER() OVER (ORDER BY {draw_sql(1, 'r_name')}, r_name) - 1, COUNT(*) OVER () FROM region)
SELECT task, k // w AS round, k AS place, name FROM t, range(120) r(k) WHERE k < 40 * w AND k % n = i""", "M7")
def cyclic_mixture(s: SparkSession, d: str) -> DataFrame:
    """The rows of forty rounds of three nations and one region."""
    tables = {"nation": table(s, d, "nation").select(F.col("n_name").alias("name")), "region": table(s, d, "region").select(F.col("r_name").alias("name"))}
    return sampling.cyclic_mix(tables, {"nation": 3, "region": 1}, "name", 40, 1)


@query(f"SELECT p_partkey, p_size FROM part WHERE p_size > 0 ORDER BY -LN(({draw_sql(4, 'p_partkey')} + 1) / {float(2**52 + 1)!r}::DOUBLE) / p_size, p_partkey LIMIT 300", "M7")
def weighted_draw(s: SparkSession, d: str) -> DataFrame:
    """Parts drawn without replacement, large ones more often."""
    return sampling.weighted_draw(table(s, d, "part").select("p_partkey", "p_size"), "p_size", "p_partkey", 300, 4)


@query(f"""WITH p AS (SELECT doc_id, toxic, ROW_NUMBER() OVER (PARTITION BY toxic ORDER BY {draw_sql(5, 'doc_id')}, doc_id) - 1 AS i, COUNT(*) OVER (PARTITION BY toxic) AS n FROM labels),
m AS (SELECT LEAST(MAX(n) FILTER (toxic = 0), 3 * MAX(n) FILTER (toxic = 1)) AS m FROM p), k AS (SELECT unnest(range(m)) AS k FROM m), v AS (SELECT k, toxic, {draw_sql(6, 'k', 'toxic')} AS u FROM k, (VALUES (0), (1)) v(toxic))
SELECT doc_id, toxic, COUNT(*) AS n_draws FROM p JOIN v USING (toxic) WHERE i = u % n GROUP BY 1, 2""", "M11")
def oversampled_draws(s: SparkSession, d: str) -> DataFrame:
    """How often each labelled row is drawn."""
    return sampling.draws_with_replacement(table(s, d, "labels").select("doc_id", "toxic"), "toxic", "doc_id", 3, 5)


@query(f"SELECT doc_id FROM labels ORDER BY {draw_sql(9, 'doc_id')}, doc_id LIMIT 100", "M13 M12")
def random_subset(s: SparkSession, d: str) -> DataFrame:
    return sampling.random_subset(table(s, d, "labels").select("doc_id"), 100, "doc_id", 9)


@query(f"SELECT doc_id, toxic FROM (SELECT doc_id, toxic, ROW_NUMBER() OVER (PARTITION BY toxic ORDER BY {draw_sql(2, 'doc_id')}, doc_id) AS i FROM labels), (SELECT MIN(n) AS m FROM (SELECT COUNT(*) AS n FROM labels GROUP BY toxic)) WHERE i <= m", "M8")
def downsampled(s: SparkSession, d: str) -> DataFrame:
    """The smaller class, and as many rows of the larger."""
    return sampling.downsample(table(s, d, "labels"), "toxic", "doc_id", 2).select("doc_id", "toxic")


@query(f"""WITH l AS (SELECT doc_id, lang, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY {draw_sql(8, 'doc_id')}, doc_id) AS i, COUNT(*) OVER (PARTITION BY lang) // 10 AS n FROM documents)
SELECT doc_id, lang, CASE WHEN i <= 3 * n THEN 'train' WHEN i <= 4 * n THEN 'valid' ELSE 'test' END AS split FROM l WHERE i <= 5 * n""", "M12 W4 M10")
def split_rows(s: SparkSession, d: str) -> DataFrame:
    """The documents of each language that go to each split."""
    docs = table(s, d, "documents").select("doc_id", "lang")
    tenth = F.floor(F.col("n_rows") / 10).cast("bigint")
    sizes = sampling.shard_counts(docs, "lang").select("lang", (3 * tenth).alias("n_train"), tenth.alias("n_valid"), tenth.alias("n_test"))
    return sampling.stratified_split(docs, "lang", "doc_id", sizes, 8)


@query(f"""WITH p AS (SELECT doc_id, toxic, ROW_NUMBER() OVER (PARTITION BY toxic ORDER BY {draw_sql(3, 'doc_id')}, doc_id) AS i, COUNT(*) OVER (PARTITION BY toxic) AS n FROM labels), m AS (SELECT MAX(n) AS m FROM p)
SELECT doc_id, toxic, (m // n + CASE WHEN i <= m % n THEN 1 ELSE 0 END)::BIGINT AS copies FROM p, m""", "M8")
def rebalanced_rows(s: SparkSession, d: str) -> DataFrame:
    """How often each row occurs when both classes have equally many."""
    return sampling.rebalance(table(s, d, "labels"), "toxic", "doc_id", 3).groupBy("doc_id", "toxic").agg(F.count("*").alias("copies"))


@query("SELECT (i + 1)::INTEGER AS model_no, 'train --model-no ' || (i + 1) || ' --n-layers ' || (CASE WHEN i < 2 THEN 2 ELSE 3 END) || ' --n-units ' || (CASE WHEN i % 2 = 0 THEN 1500 ELSE 2000 END) || ' --target ' || s_suppkey || ' --iteration 1' AS command FROM supplier, range(4) r(i)", "M16 E10")
def job_specs(s: SparkSession, d: str) -> DataFrame:
    """A command line for each target and setting."""
    targets = table(s, d, "supplier").select(F.col("s_suppkey").alias("target"))
    grid = evaluation.hyper_grid(s, {"n_layers": (2, 3), "n_units": (1500, 2000)})
    return evaluation.job_specs(evaluation.grids_for(targets, grid), "train", iteration="1")


#: Two logistic models and a linear one over the first three numbers of an embedding.
SPECS = {"a": {"kind": "logistic", "weights": [1.0, -2.0, 0.5], "bias": 0.1}, "b": {"kind": "logistic", "weights": [0.5, 0.5, 0.5], "bias": -0.2}, "c": {"kind": "linear", "weights": [2.0, 0.0, 1.0], "bias": 0.0}}


def _load_spec(name: str) -> models.Model:
    return models.from_json(json.dumps(SPECS[name]))


def _spec_sql(name: str) -> str:
    z = " + ".join(f"{w!r} * x{i}" for i, w in enumerate(SPECS[name]["weights"])) + f" + {SPECS[name]['bias']!r}"
    return f"({z})" if SPECS[name]["kind"] == "linear" else f"(1 / (1 + EXP(-({z}))))"


FEATURES_SQL = "ft AS (SELECT vec_id AS name, embedding[1]::DOUBLE AS x0, embedding[2]::DOUBLE AS x1, embedding[3]::DOUBLE AS x2, vec_id % 9 = 0 AS bad FROM embeddings)"


def _features(s: SparkSession, d: str) -> DataFrame:
    x = F.transform(F.slice("embedding", 1, 3), lambda v: v.cast("double"))
    return table(s, d, "embeddings").select(F.col("vec_id").alias("name"), F.when(F.col("vec_id") % 9 == 0, F.concat(F.slice(x, 1, 2), F.array(F.lit(float("nan"))))).otherwise(x).alias("x"))


@query(f"WITH {FEATURES_SQL} SELECT name, CASE WHEN NOT bad THEN ROUND(({_spec_sql('a')} + {_spec_sql('b')}) / 2, 6) END AS toxicity, CASE WHEN NOT bad THEN ROUND({_spec_sql('c')}, 6) END AS solubility FROM ft", "M1 M2 J23 M15 2.13-model P12")
def catalogue_scores(s: SparkSession, d: str) -> DataFrame:
    found = models.ensemble(_features(s, d), {"toxicity": ["a", "b"], "solubility": ["c"]}, "x", _load_spec)
    return found.withColumns({c: F.round(c, 6) for c in ("toxicity", "solubility")})


#: Five networks of three inputs, two rectified units and one output, by a rule; and a forest of two trees.
NETS = [{"kind": "dense", "layers": [{"weights": [[round(0.3 * (i - j) + 0.1 * k, 2) for j in range(2)] for i in range(3)], "bias": [0.1, -0.05 * k]}, {"weights": [[1.0 + 0.2 * k], [-0.7]], "bias": [0.05 * k]}]} for k in range(5)]
FOREST = {"kind": "trees", "base": 0.2, "trees": [{"feature": [0, -1, 1, -1, -1], "threshold": [0.0, 0, 0.05, 0, 0], "left": [1, 0, 3, 0, 0], "right": [2, 0, 4, 0, 0], "value": [0, -1.0, 0, 0.5, 2.0]}, {"feature": [2, -1, -1], "threshold": [-0.02, 0, 0], "left": [1, 0, 0], "right": [2, 0, 0], "value": [0, 0.25, -0.25]}]}


def _load_net(name: str) -> models.Model:
    return models.from_json(json.dumps(FOREST if name == "forest" else NETS[int(name)]))


def _unit_sql(net: dict, j: int) -> str:
    hidden = net["layers"][0]
    return "GREATEST(0, " + " + ".join(f"({hidden['weights'][i][j]!r}) * x{i}" for i in range(3)) + f" + ({hidden['bias'][j]!r}))"


def _net_sql(net: dict) -> str:
    out = net["layers"][1]
    return "1 / (1 + EXP(-(" + " + ".join(f"({out['weights'][j][0]!r}) * {_unit_sql(net, j)}" for j in range(2)) + f" + ({out['bias'][0]!r}))))"


@query(f"WITH {FEATURES_SQL} SELECT name, CASE WHEN NOT bad THEN ROUND(({' + '.join(map(_net_sql, NETS))}) / 5, 6) END AS toxicity, CASE WHEN NOT bad THEN ROUND(0.2 + CASE WHEN x0 <= 0 THEN -1.0 WHEN x1 <= 0.05 THEN 0.5 ELSE 2.0 END + CASE WHEN x2 <= -0.02 THEN 0.25 ELSE -0.25 END, 6) END AS permeability FROM ft", "M1 M2 M15 J23 2.13-model")
def network_scores(s: SparkSession, d: str) -> DataFrame:
    """The mean of five networks for one property, a forest for another."""
    found = models.ensemble(_features(s, d), {"toxicity": list("01234"), "permeability": ["forest"]}, "x", _load_net)
    return found.withColumns({c: F.round(c, 6) for c in ("toxicity", "permeability")})


@query(f"WITH {FEATURES_SQL} SELECT name, ROUND({_unit_sql(NETS[0], 0)}, 6) AS a0, ROUND({_unit_sql(NETS[0], 1)}, 6) AS a1, ROUND({_unit_sql(NETS[4], 0)}, 6) AS b0, ROUND({_unit_sql(NETS[4], 1)}, 6) AS b1 FROM ft WHERE NOT bad", "M3 K19")
def hidden_layers(s: SparkSession, d: str) -> DataFrame:
    """What the hidden units of two networks give for each row."""
    load = lambda name: lambda x: _load_net(name).layers(x)[1]
    found = models.represent(_features(s, d).filter("name % 9 != 0"), "x", {"a": "0", "b": "4"}, load)
    return found.select("name", *[F.round(F.get(c, F.lit(k)), 6).alias(f"{c}{k}") for c in "ab" for k in (0, 1)])


@query(f"WITH {FEATURES_SQL} SELECT name, 1 AS width, ROUND({_spec_sql('c')}, 6) AS value FROM ft WHERE NOT bad", "M3 K19")
def representations(s: SparkSession, d: str) -> DataFrame:
    found = models.represent(_features(s, d).filter("name % 9 != 0"), "x", {"layer": "c"}, _load_spec)
    return found.select("name", F.size("layer").alias("width"), F.round(F.get("layer", F.lit(0)), 6).alias("value"))


@query(f"WITH {FEATURES_SQL} SELECT p.name AS a, q.name AS b, ROUND((0.5 * (q.x0 + q.x1 + q.x2)) - (0.5 * (p.x0 + p.x1 + p.x2)), 6) AS difference FROM ft p JOIN ft q ON q.name = p.name + 1 WHERE NOT p.bad AND NOT q.bad", "M4")
def pair_differences(s: SparkSession, d: str) -> DataFrame:
    scores = models.ensemble(_features(s, d), {"score": ["b"]}, "x", _load_spec).filter("score IS NOT NULL")
    names = scores.select(F.col("name").alias("a"))
    return models.pair_scores(names.withColumn("b", F.col("a") + 1), scores).withColumn("difference", F.round("difference", 6))


# --- programs and machines ---------------------------------------------------------------------


@query("SELECT p_partkey AS name, CASE p_partkey % 5 WHEN 0 THEN 'exit 3' ELSE 'ok' END AS status, CASE WHEN p_partkey % 5 > 0 THEN upper(p_name) END AS output FROM part", "E2 E3 C12")
def prepared_rows(s: SparkSession, d: str) -> DataFrame:
    """A chain of two programs; the first fails for some rows."""
    rows = table(s, d, "part").select(F.col("p_partkey").alias("name"), F.when(F.col("p_partkey") % 5 == 0, "bad").otherwise(F.col("p_name")).alias("smiles"))
    chain = [["sh", "-c", 'read -r x; [ "$x" = bad ] && exit 3; printf %s "$x"'], ["tr", "a-z", "A-Z"]]
    done = processes.prepare(rows, chain, "smiles", timeout=20)
    return done.select("name", "status", F.when(F.col("status") == "ok", F.col("output")).alias("output"))


@query("SELECT n_nationkey AS name, CASE WHEN n_nationkey % 7 = 0 THEN 'timeout' WHEN n_nationkey % 7 = 1 THEN 'not started: No such file or directory' ELSE 'ok' END AS status FROM nation", "E1 E2")
def program_status(s: SparkSession, d: str) -> DataFrame:
    k = F.col("n_nationkey")
    rows = table(s, d, "nation").select(k.alias("name"), F.when(k % 7 == 0, "sleep").when(k % 7 == 1, "no-such-program").otherwise("true").alias("program"), F.when(k % 7 == 0, "5").otherwise("0").alias("argument"))
    return processes.for_each(rows, ["{program}", "{argument}"], timeout=1).select("name", "status")


@query("SELECT p_partkey AS name, 'ok' AS status, 'gpu ' || p_name AS output FROM part", "E4 E5 E7")
def docked_rows(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "part").select(F.col("p_partkey").alias("name"), F.col("p_name").alias("ligand"))
    done = processes.dock(rows, ["sh", "-c", '[ "$CUDA_VISIBLE_DEVICES" -lt 4 ] && printf "gpu " && cat'], "ligand", "name", workers=6, gpus=4, timeout=20)
    return done.select("name", "status", "output")


@query("SELECT p_partkey AS name, CASE WHEN p_partkey % 4 = 0 THEN -1 ELSE p_size END::INTEGER AS total_hbonds, CASE WHEN p_partkey % 4 = 0 THEN -1 ELSE p_size % 3 END::INTEGER AS key_residue_hbonds FROM part", "C15")
def interaction_counts(s: SparkSession, d: str) -> DataFrame:
    value = F.when(F.col("p_partkey") % 4 == 0, "broken").otherwise(F.concat_ws(" ", F.col("p_size").cast("string"), (F.col("p_size") % 3).cast("string")))
    return processes.interactions(table(s, d, "part").select(F.col("p_partkey").alias("name"), value.alias("value")), lambda text: tuple(map(int, text.split())))


@query("SELECT o_orderkey AS job, (ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1)::BIGINT // 12 AS wave, (ROW_NUMBER() OVER (ORDER BY o_orderkey) - 1)::BIGINT % 4 AS worker FROM orders", "E10 E5")
def job_waves(s: SparkSession, d: str) -> DataFrame:
    return resources.waves(table(s, d, "orders").select(F.col("o_orderkey").alias("job")), "job", 4, 3)


@query("SELECT o_orderkey AS job FROM orders WHERE o_orderstatus = 'P' AND o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' ORDER BY o_orderkey LIMIT 3) ORDER BY o_orderkey LIMIT 5", "T7")
def waiting_jobs(s: SparkSession, d: str) -> DataFrame:
    jobs = table(s, d, "orders").select(F.col("o_orderkey").alias("job"), "o_orderstatus")
    running = jobs.filter("o_orderstatus = 'P'").orderBy("job").limit(3).select("job")
    return resources.waiting(jobs.select("job"), "job", jobs.filter("o_orderstatus != 'P'").select("job"), running, 8)


@query("SELECT 'h' || (s_nationkey % 2) AS host, s_suppkey::VARCHAR AS gpu_id, (s_suppkey * 97 % 24000)::INTEGER AS used_mb, (s_suppkey * 37 % 100)::INTEGER AS util FROM supplier WHERE s_suppkey % 5 > 0", "E6")
def gpu_lines(s: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    line = F.format_string("h%d: %d, %d MiB, %d %%", F.col("s_nationkey") % 2, k, k * 97 % 24000, k * 37 % 100)
    return resources.parse_gpus(table(s, d, "supplier").select(F.when(k % 5 == 0, "no processes found").otherwise(line).alias("value")))


@query("SELECT 'n' || s_suppkey AS node, (s_suppkey % 16)::INTEGER AS ncpu, CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE s_nationkey / 4.0 END::DOUBLE AS load FROM supplier", "E6")
def node_lines(s: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    load = F.when(k % 3 == 0, F.lit("?")).otherwise((F.col("s_nationkey") / F.lit(4.0)).cast("string"))
    return resources.parse_nodes(table(s, d, "supplier").select(F.concat(F.lit("n"), k.cast("string"), F.lit(" ncpu="), (k % 16).cast("string"), F.lit(" load="), load).alias("value")))


@query("WITH p AS (SELECT s_name AS node, GREATEST((s_suppkey % 16) * 1.5 - (s_nationkey % 9), 0)::DOUBLE * (1 + s_suppkey % 2) AS power FROM supplier) SELECT node, power FROM p ORDER BY power DESC, node LIMIT 1", "O9 F26")
def best_node(s: SparkSession, d: str) -> DataFrame:
    nodes = table(s, d, "supplier").select(F.col("s_name").alias("node"), (F.col("s_suppkey") % 16).alias("ncpu"), (F.col("s_nationkey") % 9).alias("load"), (1 + F.col("s_suppkey") % 2).alias("factor"), F.lit(60).alias("wanted"))
    return resources.best_node(resources.slots(nodes)).select("node", "power")


# --- streams -----------------------------------------------------------------------------------


def _streamed(s: SparkSession, d: str, views: dict[str, progress.View]) -> dict[str, DataFrame]:
    """The last state of each view after the log has come in three batches, as it was written."""
    path, log = scratch(s), _log(s, d)
    for k in range(3):
        log.filter(F.col("seq") % 3 == k).coalesce(1).write.mode("append").json(f"{path}/log")
    stream = progress.read_log(s, f"{path}/log", files_per_batch=1)
    for q in progress.follow(stream, views, lambda name, rows, number: rows.write.mode("overwrite").parquet(f"{path}/out/{name}/{number}"), f"{path}/state"):
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    return {name: s.read.parquet(f"{path}/out/{name}/2") for name in views}


@query("""WITH m AS (SELECT event_id, LEAST(7, event_id * 8 // 12000) AS k FROM events WHERE event_type = 'signup'), g AS (SELECT k, MIN(event_id) AS first_seq, MAX(event_id) AS last FROM m GROUP BY 1)
SELECT ['library', 'receptor', 'physchem', 'admet', 'druglikeness', 'prepare_ligand', 'docking', 'results'][k + 1] AS module, first_seq, last <> (SELECT MAX(last) FROM g) AS completed, CAST(k * 100 // 7 AS INTEGER) AS progress FROM g""", "T1 T2 T6")
def followed_modules(s: SparkSession, d: str) -> DataFrame:
    return _streamed(s, d, {"modules": progress.transition_view()})["modules"].select("module", "first_seq", "completed", "progress")


@query("SELECT CAST(SUM(event_id % 300) AS BIGINT) AS done, CAST(LEAST(100, FLOOR(SUM(event_id % 300) * 100 / 500000.0)) AS INTEGER) AS percent, (SELECT CAST(event_id % 100 AS INTEGER) FROM events WHERE event_type = 'click' ORDER BY event_id DESC LIMIT 1) AS latest FROM events WHERE event_type = 'purchase'", "T3 T4 A29")
def followed_progress(s: SparkSession, d: str) -> DataFrame:
    shown = _streamed(s, d, {"done": progress.batch_view(500_000), "latest": progress.percent_view()})
    return shown["done"].select("done", "percent").crossJoin(F.broadcast(shown["latest"].select(F.col("percent").alias("latest"))))  # one row each


@query("SELECT event_id AS seq FROM events ORDER BY event_id DESC LIMIT 1000", "T5 T6")
def followed_tail(s: SparkSession, d: str) -> DataFrame:
    path = scratch(s)
    for k in range(3):
        _log(s, d).filter(F.col("seq") % 3 == k).coalesce(1).write.mode("append").json(f"{path}/log")
    progress.follow_tail(progress.read_log(s, f"{path}/log", files_per_batch=1), 1000, f"{path}/tail", lambda *_: None, f"{path}/state").awaitTermination()
    return s.read.parquet(f"{path}/tail/batch=2").select("seq")


#: Events as lines of twelve runs.
RUN_SQL = """ev AS (SELECT event_id AS seq, ts, 'run' || (user_id % 12) AS run, CASE WHEN event_type = 'signup' THEN LEAST(7, event_id * 8 // 12000) END AS k,
  CASE WHEN event_type = 'click' THEN event_id % 100 END AS percent, CASE WHEN event_type = 'purchase' THEN event_id % 300 END AS size FROM events),
m AS (SELECT run, k, MIN(seq) AS first, MAX(seq) AS last FROM ev WHERE k IS NOT NULL GROUP BY 1, 2), cur AS (SELECT run, arg_max(k, last) AS k FROM m GROUP BY 1),
names AS (SELECT ['library', 'receptor', 'physchem', 'admet', 'druglikeness', 'prepare_ligand', 'docking', 'results'] AS n),
cp AS (SELECT m.run, string_agg(n[m.k + 1], ',' ORDER BY first) AS completed FROM m JOIN cur USING (run), names WHERE m.k <> cur.k GROUP BY 1)
SELECT run, COUNT(*) AS lines, CAST(COALESCE(SUM(size), 0) AS BIGINT) AS done, CAST(arg_max(percent, seq) FILTER (percent IS NOT NULL) AS INTEGER) AS percent, ANY_VALUE(n[cur.k + 1]) AS current, COALESCE(ANY_VALUE(completed), '') AS completed, MAX(ts) AS last_ts
FROM ev LEFT JOIN cur USING (run) LEFT JOIN cp USING (run), names GROUP BY run"""


def _run_log(s: SparkSession, d: str) -> DataFrame:
    user = table(s, d, "events").select(F.col("event_id").alias("seq"), F.concat(F.lit("run"), F.col("user_id") % 12).alias("run"))
    return _log(s, d).join(user, "seq").select("run", "seq", "ts", "message")


def _shown(states: DataFrame) -> DataFrame:
    return states.select("run", "lines", "done", "percent", "current", F.array_join("completed", ",").alias("completed"), F.col("last_ts").cast("timestamp_ntz").alias("last_ts"))


@query(f"WITH {RUN_SQL}", "T1 T2 T3 T4")
def run_states(s: SparkSession, d: str) -> DataFrame:
    """The status of each of many runs, from their whole log."""
    return _shown(runs.run_states(_run_log(s, d)))


@query(f"WITH {RUN_SQL}", "T1 T2 T3 T4 T6")
def followed_runs(s: SparkSession, d: str) -> DataFrame:
    """The same, followed as a stream that brings the runs' lines mixed, in three batches, a third of them twice."""
    path, log = scratch(s), _run_log(s, d)
    for k in range(3):  # what has come is one batch, and the next start goes on from the state
        log.filter((F.col("seq") % 3 == k) | (F.col("seq") % 9 == (k + 2) % 3)).write.mode("append").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(f"{path}/log")
        stream = s.readStream.schema(runs.RUN_LOG).json(f"{path}/log")
        runs.write_updates(runs.follow_runs(stream, late="60 days"), f"{path}/updates", f"{path}/state").awaitTermination()
    return _shown(runs.latest_states(s, f"{path}/updates"))


def _jobs(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    events = table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    jobs = events.filter("event_type = 'signup'").select(F.col("user_id").alias("job"), F.col("ts").alias("submitted"))
    return jobs, events.filter("event_type = 'purchase'").select(F.col("user_id").alias("job"), F.col("ts").alias("finished"))


OVERDUE_SQL = """WITH j AS (SELECT user_id AS job, ts AS submitted FROM events WHERE event_type = 'signup'), c AS (SELECT user_id AS job, ts AS finished FROM events WHERE event_type = 'purchase')
SELECT j.job, submitted, finished FROM j LEFT JOIN c ON j.job = c.job AND finished >= submitted AND finished <= submitted + INTERVAL 12 HOUR"""


@query(OVERDUE_SQL, "T7")
def overdue_jobs(s: SparkSession, d: str) -> DataFrame:
    """Jobs with their completions as two streams, in two runs from one checkpoint; a last line of a clock lets all deadlines pass."""
    path, sides = scratch(s), _jobs(s, d)
    names = (("job", "submitted"), ("job", "finished"))
    schemas = [", ".join(f"{n} {'bigint' if n == 'job' else 'timestamp'}" for n in pair) for pair in names]
    middle, end = F.lit("2024-01-15").cast("timestamp"), F.lit("2030-01-01").cast("timestamp")
    for half in range(2):
        for k, (rows, (_, time)) in enumerate(zip(sides, names, strict=True)):
            rows.filter(F.col(time) < middle if half == 0 else F.col(time) >= middle).write.mode("append").parquet(f"{path}/{k}")
            if half:
                s.range(1).select(F.lit(-1).cast("bigint").alias("job"), end.alias(time)).write.mode("append").parquet(f"{path}/{k}")
        jobs, completions = (s.readStream.schema(x).parquet(f"{path}/{k}") for k, x in enumerate(schemas))
        runs.write_updates(runs.overdue(jobs, completions, "12 HOURS"), f"{path}/out", f"{path}/state", "append").awaitTermination()
    found = s.read.schema("job bigint, submitted timestamp, finished timestamp, batch int").parquet(f"{path}/out").filter("job >= 0")
    return found.select("job", F.col("submitted").cast("timestamp_ntz").alias("submitted"), F.col("finished").cast("timestamp_ntz").alias("finished"))


# --- training ----------------------------------------------------------------------------------

#: Embeddings whose first number is well away from zero; its sign is the label.
CLEAR_SQL = "cl AS (SELECT vec_id AS id, (embedding[1] > 0)::INTEGER AS label, vec_id % 3 AS fold FROM embeddings WHERE ABS(embedding[1]) > 0.08)"


def _clear(s: SparkSession, d: str) -> DataFrame:
    first = F.get("embedding", F.lit(0))
    rows = table(s, d, "embeddings").filter(F.abs(first) > 0.08)
    return rows.select(F.col("vec_id").alias("id"), (first > 0).cast("int").alias("label"), F.transform(F.slice("embedding", 1, 2), lambda v: v.cast("double") * 10).alias("features"), (F.col("vec_id") % 3).alias("fold"))


@query(f"WITH {CLEAR_SQL} SELECT id, label, label AS predicted, TRUE AS loaded_same FROM cl", "M10 M15 M17")
def trained_hits(s: SparkSession, d: str) -> DataFrame:
    """A model of rows that a line parts, its predictions, and those of the model written and read again."""
    rows, path = _clear(s, d), scratch(s)
    model = training.train(rows, positive_weight=1.5, penalty=1e-4)
    training.save(model, path, s.createDataFrame([("classes", 2)], "fact string, value int"))
    again, facts = training.load(s, path)
    both = training.scored(again, training.scored(model, rows), out="q").crossJoin(F.broadcast(facts.select(F.col("value").alias("_classes"))))
    return both.select("id", "label", (F.col("p") >= 0.5).cast("int").alias("predicted"), ((F.col("p") == F.col("q")) & (F.col("_classes") == 2)).alias("loaded_same"))


@query(f"WITH {CLEAR_SQL} SELECT fold::INTEGER AS fold, 1.0::DOUBLE AS auc, TRUE AS stopped FROM cl GROUP BY 1", "M9 M6")
def cross_validation(s: SparkSession, d: str) -> DataFrame:
    """Penalties from mild to so hard that nothing is learned: the last ones are not tried."""
    found = training.cross_validated(_clear(s, d), "fold", (1e-4, 1e-3, 1e9, 1e9, 1e9, 1e9), patience=2, lasso=1.0)
    return s.createDataFrame([(int(f.fold), round(f.auc, 6), f.tried == 4) for f, _ in found], "fold int, auc double, stopped boolean")


@query(f"WITH {SCORED_SQL} SELECT ROUND(SUM(ROUND(CASE label WHEN 1 THEN -0.25 * POWER(1 - p, 2) * LN(p) ELSE -0.75 * POWER(p, 2) * LN(1 - p) END, 6)::DECIMAL(20,6))::DOUBLE, 6) AS loss, COUNT(*) AS n FROM (SELECT GREATEST(1e-7, LEAST(1 - 1e-7, score / 4000)) AS p, label FROM sc)", "M5")
def focal_losses(s: SparkSession, d: str) -> DataFrame:
    loss = F.round(training.focal_loss(F.col("score") / 4000, F.col("label")), 6).cast("decimal(20,6)")
    return _scored(s, d).agg(F.round(F.sum(loss).cast("double"), 6).alias("loss"), F.count("*").alias("n"))


@query(f"SELECT id, CASE WHEN i <= 72 THEN 'train' WHEN i <= 96 THEN 'valid' ELSE 'test' END AS split, ROUND(-balance / 1000, 6) AS score, TRUE AS resumed_same FROM (SELECT c_custkey AS id, c_acctbal AS balance, ROW_NUMBER() OVER (ORDER BY {draw_sql(12, 'c_custkey')}, c_custkey) AS i FROM customer) WHERE i <= 120", "E9 M10 M15")
def active_learning(s: SparkSession, d: str) -> DataFrame:
    """What two iterations over the customers, whose score falls with their balance, label first; the run is started again and its
    survivors stay the same, some but not all of the library."""
    path = scratch(s)
    library = table(s, d, "customer").select(F.col("c_custkey").alias("id"), F.array(F.col("c_acctbal") / 1000, (F.col("c_nationkey") % 5).cast("double")).alias("features"))
    label = lambda rows: rows.withColumn("score", -F.get("features", F.lit(0)))
    config = active_loop.LoopConfig(path, iterations=2, sample=120, hit_share=0.2)
    left = active_loop.run(library, label, config)
    n, again = left.count(), active_loop.run(library, label, config)
    same = left.select("id").join(again.select("id"), "id").count() == n == again.count() and 0 < n < library.count()
    return commits.read(s, f"{path}/iteration=1/labels").select("id", "split", F.round("score", 6).alias("score"), F.lit(same).alias("resumed_same"))


@query("SELECT p_partkey AS row_id, 'nsteps = ' || (p_partkey * 10) || ' gen' AS value FROM part WHERE p_partkey % 4 > 0", "E8")
def edited_files(s: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    value = F.when(k % 4 == 0, "; a comment").otherwise(F.concat(F.lit("nsteps   = "), k.cast("string"), F.lit(" old")))
    lines = table(s, d, "part").select(k.alias("row_id"), value.alias("value"))
    return remote.edit_lines(lines, [("\\s+", " "), ("(\\d) ", "$10 "), ("old$", "gen")], drop="^;").select("row_id", "value")
