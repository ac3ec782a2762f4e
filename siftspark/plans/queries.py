"""Registered queries on the driver's tables, and the same in SQL.

The tables stand in for screening data: parts are molecules with properties,
line items their docking runs and votes, embeddings (sign bits) fingerprints,
events a log. Every query runs over its whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.operators import clustering, dedup, evaluation, filters, joins, resources, sampling, scoring, sets, similarity, structure, topk
from siftspark.plans.config import Config
from siftspark.plans.registry import ORACLES, QUERIES, Query, query
from siftspark.plans.screening import Screening, funnel_counts
from siftspark.session import table
from siftspark.streaming import progress


# --- stand-in views, in both languages ---------------------------------------------------------

DOCK_SQL = """dock AS (SELECT l_partkey AS name, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) / COUNT(*) / -1000 AS dock_score FROM lineitem GROUP BY 1),
hb AS (SELECT l_partkey AS name, COUNT(*) AS total_hbonds, COUNT(*) FILTER (l_returnflag = 'R') AS key_residue_hbonds FROM lineitem WHERE l_discount > 0.02 GROUP BY 1),
props AS (SELECT p_partkey AS name, p_retailprice / 3 AS MW, p_size / 10.0 AS LogP, p_size % 15 AS nHA, p_size % 7 AS nHD, p_partkey % 13 AS nRot FROM part),
ad AS (SELECT l_partkey AS name, CAST(MIN(l_tax) AS DOUBLE) * 10 AS admet_score FROM lineitem WHERE l_quantity > 10 GROUP BY 1),
votes AS (SELECT l_partkey AS name, MAX(CASE WHEN l_linenumber = 1 THEN l_tax * 12 END) AS m1, MAX(CASE WHEN l_linenumber = 2 THEN l_discount * 12 END) AS m2, MAX(CASE WHEN l_linenumber = 3 THEN l_tax * 10 END) AS m3, MAX(CASE WHEN l_linenumber = 4 THEN l_discount * 8 END) AS m4, MAX(CASE WHEN l_linenumber = 5 THEN l_tax * 9 END) AS m5 FROM lineitem GROUP BY 1)"""


def _dock(s: SparkSession, d: str) -> DataFrame:
    total = F.sum(F.col("l_extendedprice").cast("decimal(18,4)")).cast("double")
    return table(s, d, "lineitem").groupBy(F.col("l_partkey").alias("name")).agg((total / F.count("*") / -1000).alias("dock_score"))


def _hbonds(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "lineitem").filter("l_discount > 0.02")
    return rows.groupBy(F.col("l_partkey").alias("name")).agg(F.count("*").alias("total_hbonds"), F.count_if(F.col("l_returnflag") == "R").alias("key_residue_hbonds"))


def _props(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "part").select(F.col("p_partkey").alias("name"), (F.col("p_retailprice") / 3).alias("MW"), (F.col("p_size") / F.lit(10.0)).alias("LogP"), (F.col("p_size") % 15).alias("nHA"), (F.col("p_size") % 7).alias("nHD"), (F.col("p_partkey") % 13).alias("nRot"))


def _admet(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "lineitem").filter("l_quantity > 10").groupBy(F.col("l_partkey").alias("name")).agg((F.min("l_tax").cast("double") * 10).alias("admet_score"))


def _votes(s: SparkSession, d: str) -> DataFrame:
    parts = (("m1", 1, "l_tax", 12), ("m2", 2, "l_discount", 12), ("m3", 3, "l_tax", 10), ("m4", 4, "l_discount", 8), ("m5", 5, "l_tax", 9))
    return table(s, d, "lineitem").groupBy(F.col("l_partkey").alias("name")).agg(*[F.max(F.when(F.col("l_linenumber") == n, F.col(c) * k)).alias(m) for m, n, c, k in parts])


MODELS = ("m1", "m2", "m3", "m4", "m5")
VOTE_SQL = " + ".join(f"CASE WHEN {m} > 0.5 THEN 1 ELSE 0 END" for m in MODELS)

RANKED_SQL = f"""WITH {DOCK_SQL},
j AS (SELECT d.name, d.dock_score, COALESCE(hb.key_residue_hbonds, 0.0) AS hbf, hb.total_hbonds, COALESCE(ad.admet_score, (SELECT MEDIAN(ad2.admet_score) FROM dock d2 LEFT JOIN ad ad2 USING (name))) AS adf, CAST(COALESCE({VOTE_SQL}, 0) AS DOUBLE) AS dl
  FROM dock d LEFT JOIN hb USING (name) LEFT JOIN ad USING (name) LEFT JOIN votes USING (name)),
x AS (SELECT MIN(dock_score) a0, MAX(dock_score) a1, MIN(hbf) b0, MAX(hbf) b1, MIN(adf) c0, MAX(adf) c1, MIN(dl) d0, MAX(dl) d1 FROM j),
c AS (SELECT name, dock_score, ROUND((1.0 * CASE WHEN a0 = a1 THEN 1 ELSE (a1 - dock_score) / (a1 - a0) END + 0.5 * CASE WHEN b0 = b1 THEN 1 ELSE (hbf - b0) / (b1 - b0) END
   + 0.5 * CASE WHEN c0 = c1 THEN 1 ELSE (adf - c0) / (c1 - c0) END + 0.3 * CASE WHEN d0 = d1 THEN 1 ELSE (dl - d0) / (d1 - d0) END) / (1.0 + 0.5 + 0.5 + 0.3), 6) AS composite_score FROM j, x)
"""


def _joined(s: SparkSession, d: str) -> DataFrame:
    dln = _votes(s, d).select("name", filters.votes(MODELS).alias("dln_count"))
    return joins.left_join_all(_dock(s, d), [_hbonds(s, d), _admet(s, d), dln], "name")


# --- ranking -----------------------------------------------------------------------------------


@query(RANKED_SQL + "SELECT name, ROUND(dock_score, 10) AS dock_score, composite_score, CAST(RANK() OVER (ORDER BY composite_score DESC) AS INTEGER) AS rank FROM c")
def ranked_hits(s: SparkSession, d: str) -> DataFrame:
    return scoring.ranked_composite(_joined(s, d)).select("name", F.round("dock_score", 10).alias("dock_score"), "composite_score", "rank")


@query(RANKED_SQL + "SELECT name, composite_score, CAST(RANK() OVER (ORDER BY composite_score DESC) AS INTEGER) AS rank FROM c ORDER BY composite_score DESC, name LIMIT 100")
def top_n_hits(s: SparkSession, d: str) -> DataFrame:
    ranked = scoring.ranked_composite(_joined(s, d))
    return scoring.top_n(ranked, 100, "name").select("name", "composite_score", "rank")


@query(f"""WITH {DOCK_SQL} SELECT COUNT(*) AS n, ROUND(MIN(dock_score), 6) AS min_score, ROUND(CAST(SUM(CAST(r AS DECIMAL(18,6))) AS DOUBLE) / COUNT(*), 6) AS mean_score, ROUND(MEDIAN(r), 6) AS median_score, ROUND(MAX(dock_score), 6) AS max_score,
ROUND(CAST(COUNT(*) FILTER (key_residue_hbonds >= 1) AS DOUBLE) / COUNT(*), 6) AS hbond_share FROM (SELECT *, ROUND(dock_score, 6) AS r FROM dock LEFT JOIN hb USING (name))""")
def hit_summary(s: SparkSession, d: str) -> DataFrame:
    rows = joins.left_join_all(_dock(s, d).withColumn("dock_score", F.round("dock_score", 6)), [_hbonds(s, d)], "name")
    return scoring.summary(rows, "dock_score", "key_residue_hbonds")


# --- filters -----------------------------------------------------------------------------------

BOUNDS = {"MW": (310.0, 330.0), "LogP": (0.5, 4.0), "nHA": (None, 10), "nHD": (None, 4), "nRot": (None, 9)}


@query(f"WITH {DOCK_SQL} SELECT name, MW, LogP FROM props WHERE (CASE WHEN MW BETWEEN 310 AND 330 THEN 1 ELSE 0 END + CASE WHEN LogP BETWEEN 0.5 AND 4 THEN 1 ELSE 0 END + CASE WHEN nHA <= 10 THEN 1 ELSE 0 END + CASE WHEN nHD <= 4 THEN 1 ELSE 0 END + CASE WHEN nRot <= 9 THEN 1 ELSE 0 END) >= 4")
def kofn_property_vote(s: SparkSession, d: str) -> DataFrame:
    return filters.property_vote(_props(s, d), BOUNDS, 4).select("name", "MW", "LogP")


@query(f"WITH {DOCK_SQL} SELECT p.name, MW FROM props p JOIN ad USING (name) WHERE admet_score >= 0.1 AND MW >= 305 AND LogP <= 4.5 AND nHA <= 12 AND nRot IS NOT NULL")
def conjunctive_endpoint_filter(s: SparkSession, d: str) -> DataFrame:
    rows = _props(s, d).join(_admet(s, d), "name")
    return filters.all_within(rows, {"admet_score": (0.1, None), "MW": (305, None), "LogP": (None, 4.5), "nHA": (None, 12), "nRot": (None, float("inf"))}).select("name", "MW")


@query(f"WITH {DOCK_SQL} SELECT name, {VOTE_SQL} AS votes FROM votes WHERE {VOTE_SQL} >= 3")
def model_vote_filter(s: SparkSession, d: str) -> DataFrame:
    return filters.vote_filter(_votes(s, d), MODELS, 3).select("name", "votes")


@query(f"WITH {DOCK_SQL} SELECT p_partkey AS name, p_name AS smiles, total_hbonds, key_residue_hbonds FROM hb JOIN part ON p_partkey = name WHERE key_residue_hbonds > 0")
def key_count_filter(s: SparkSession, d: str) -> DataFrame:
    library = table(s, d, "part").select(F.col("p_partkey").alias("name"), F.col("p_name").alias("smiles"), F.col("p_partkey").alias("row_id"))
    return joins.lookup_last(filters.with_key_bonds(_hbonds(s, d)), library, "name", "row_id").select("name", "smiles", "total_hbonds", "key_residue_hbonds")


@query("""WITH x AS (SELECT p_partkey AS name, p_retailprice / 2 AS MW, p_size / 8.0 AS LogP, p_size AS MR, p_size % 12 AS naccr, p_size % 8 AS ndonr, p_size + 10 AS nta, p_size % 5 AS nring, p_size AS nrigidbond, p_size % 14 AS nRotbond, p_retailprice / 7 AS TPSA, p_size / 9.0 AS D FROM part)
SELECT name, ((CASE WHEN MW <= 500 THEN 1 ELSE 0 END) + (CASE WHEN LogP <= 5 THEN 1 ELSE 0 END) + (CASE WHEN naccr <= 10 THEN 1 ELSE 0 END) + (CASE WHEN ndonr <= 5 THEN 1 ELSE 0 END)) / 4.0::DOUBLE AS Lipinski,
((CASE WHEN LogP > 0.4 AND LogP < 5.6 THEN 1 ELSE 0 END) + (CASE WHEN MW > 160 AND MW < 480 THEN 1 ELSE 0 END) + (CASE WHEN MR > 40 AND MR < 130 THEN 1 ELSE 0 END) + (CASE WHEN nta > 20 AND nta < 70 THEN 1 ELSE 0 END)) / 4.0::DOUBLE AS Ghose,
ROUND(((CASE WHEN nring >= 3 THEN 1 ELSE 0 END) + (CASE WHEN nrigidbond >= 18 THEN 1 ELSE 0 END) + (CASE WHEN nRotbond >= 6 THEN 1 ELSE 0 END)) / 3.0::DOUBLE, 6) AS Oprea,
((CASE WHEN nRotbond <= 10 THEN 1 ELSE 0 END) + (CASE WHEN TPSA <= 140 OR naccr + ndonr <= 12 THEN 1 ELSE 0 END)) / 2.0::DOUBLE AS Veber,
((CASE WHEN MW <= 500 THEN 1 ELSE 0 END) + (CASE WHEN TPSA <= 125 THEN 1 ELSE 0 END) + (CASE WHEN D > 2 AND D < 5 THEN 1 ELSE 0 END) + (CASE WHEN naccr + ndonr <= 9 THEN 1 ELSE 0 END) + (CASE WHEN nRotbond <= 12 THEN 1 ELSE 0 END)) / 5.0::DOUBLE AS Varma FROM x""")
def rule_scores(s: SparkSession, d: str) -> DataFrame:
    p, size = F.col("p_retailprice"), F.col("p_size")
    x = table(s, d, "part").select(F.col("p_partkey").alias("name"), (p / 2).alias("MW"), (size / 8.0).alias("LogP"), size.alias("MR"), (size % 12).alias("naccr"), (size % 8).alias("ndonr"), (size + 10).alias("nta"), (size % 5).alias("nring"), size.alias("nrigidbond"), (size % 14).alias("nRotbond"), (p / 7).alias("TPSA"), (size / 9.0).alias("LogD7.4"))
    rules = filters.rule_scores()
    return x.select("name", *[(F.round(c, 6) if k == "Oprea" else c).alias(k) for k, c in rules.items()])


@query(f"WITH {DOCK_SQL} SELECT name, ROUND((m1 + m2) / 2, 6) AS mean_score FROM votes WHERE m1 > 0.5 OR m2 > 0.9")
def survivor_filter(s: SparkSession, d: str) -> DataFrame:
    rows = _votes(s, d).select("name", F.array("m1", "m2").alias("p"))
    return filters.survivors(rows, "p", (0.5, 0.9)).select("name", F.round("mean_score", 6).alias("mean_score"))


@query(f"WITH {DOCK_SQL} SELECT name, COALESCE((CASE WHEN m1 >= 0.3 THEN 1 ELSE 0 END + CASE WHEN m2 >= 0.4 THEN 1 ELSE 0 END + CASE WHEN m3 >= 0.2 THEN 1 ELSE 0 END) > 1, FALSE) AS hit FROM votes WHERE m1 IS NOT NULL AND m2 IS NOT NULL AND m3 IS NOT NULL")
def consensus_vote(s: SparkSession, d: str) -> DataFrame:
    rows = _votes(s, d).filter("m1 IS NOT NULL AND m2 IS NOT NULL AND m3 IS NOT NULL")
    return rows.select("name", filters.consensus(F.array("m1", "m2", "m3"), F.array(F.lit(0.3), F.lit(0.4), F.lit(0.2)), 3).alias("hit"))


@query("SELECT p_partkey AS name, replace(p_name, 'a', '.') AS smiles FROM part WHERE NOT contains(p_name, 'a')")
def pattern_reject(s: SparkSession, d: str) -> DataFrame:
    mixtures = table(s, d, "part").select(F.col("p_partkey").alias("name"), F.translate("p_name", "a", ".").alias("smiles"))
    return mixtures.filter(filters.single_component(F.col("smiles")))


@query("SELECT page_id, CAST(contains(html, '<table') AS INTEGER) AS m0, CAST(contains(html, '<li>') AS INTEGER) AS m1, CAST(contains(html, '<p>') AS INTEGER) AS m2 FROM pages WHERE contains(html, '<table') OR contains(html, '<li>') OR contains(html, '<p>')")
def any_match(s: SparkSession, d: str) -> DataFrame:
    return filters.matches_any(table(s, d, "pages"), "html", ("<table", "<li>", "<p>")).filter("any_match").select("page_id", "m0", "m1", "m2")


# --- joins, sets and de-duplication ------------------------------------------------------------


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)")
def semi_join_filter(s: SparkSession, d: str) -> DataFrame:
    rich = table(s, d, "customer").filter("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return joins.keep_selected(table(s, d, "orders"), rich, "o_custkey").select("o_orderkey", "o_totalprice")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def anti_join_filter(s: SparkSession, d: str) -> DataFrame:
    big = table(s, d, "orders").filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.drop_known(table(s, d, "customer"), big, "c_custkey").select("c_custkey", "c_name")


@query("WITH a AS (SELECT l_partkey AS name, MAX(l_tax) v FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1), r AS (SELECT l_partkey AS name, MAX(l_discount) v FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) SELECT name, a.v AS a, r.v AS r FROM a FULL JOIN r USING (name)")
def outer_vote_merge(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "lineitem")
    of = lambda flag, c: rows.filter(F.col("l_returnflag") == flag).groupBy(F.col("l_partkey").alias("name")).agg(F.max(c).alias("v"))
    return joins.merge_votes({"a": of("A", "l_tax"), "r": of("R", "l_discount")}, "name", "v")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) rn FROM events) WHERE rn = 1")
def dedup_first(s: SparkSession, d: str) -> DataFrame:
    return dedup.first_wins(table(s, d, "events"), ["user_id"], F.struct("ts", "event_id")).select("user_id", "event_id", "event_type")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) rn FROM events) WHERE rn = 1")
def dedup_last(s: SparkSession, d: str) -> DataFrame:
    return dedup.last_wins(table(s, d, "events"), ["user_id"], F.struct("ts", "event_id")).select("user_id", "event_id", "event_type")


LABELLED_SQL = "WITH r AS (SELECT source || ':' || lang || ':' || (n_chars % 50)::VARCHAR AS key, CAST(toxic AS DOUBLE) AS label, doc_id FROM documents JOIN labels USING (doc_id)), g AS (SELECT key, MIN(label) lo, MAX(label) hi, SUM(label) / COUNT(*) mean, ARG_MIN(label, doc_id) first, COUNT(*) AS n_rows FROM r GROUP BY 1) "


def _policy(name: str) -> Query:
    def run(s: SparkSession, d: str) -> DataFrame:
        docs = table(s, d, "documents").select("doc_id", "source", "lang", "n_chars").join(table(s, d, "labels"), "doc_id")
        keyed = docs.select(F.concat_ws(":", "source", "lang", (F.col("n_chars") % 50).cast("string")).alias("key"), F.col("toxic").alias("label"), "doc_id")
        out = dedup.resolve_labels(keyed, "key", "label", "doc_id", name)
        return out.withColumn("label", F.round("label", 6))

    return run


for _name, _value in (("keep_first", "first"), ("mean", "mean"), ("remove_positive", "lo"), ("remove_negative", "hi"), ("remove_all", "CASE WHEN lo = hi THEN lo END")):
    QUERIES[f"dedup_policy_{_name}"] = _policy(_name)
    ORACLES[f"dedup_policy_{_name}"] = LABELLED_SQL + f"SELECT key, ROUND({_value}, 6) AS label, n_rows FROM g WHERE ({_value}) IS NOT NULL"
QUERIES["dedup_policy_keep_all"] = _policy("keep_all")
ORACLES["dedup_policy_keep_all"] = LABELLED_SQL + "SELECT key, label, COUNT(*) AS n_rows FROM r GROUP BY 1, 2"


@query("SELECT doc_id AS id, text FROM documents UNION ALL SELECT item_id, text FROM benchmark")
def collection_union(s: SparkSession, d: str) -> DataFrame:
    return sets.concatenate(table(s, d, "documents").select(F.col("doc_id").alias("id"), "text"), table(s, d, "benchmark").select(F.col("item_id").alias("id"), "text"))


@query("SELECT c_nationkey AS key FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def collection_intersect(s: SparkSession, d: str) -> DataFrame:
    return sets.common_keys(table(s, d, "customer").withColumnRenamed("c_nationkey", "k"), table(s, d, "supplier").withColumnRenamed("s_nationkey", "k"), F.col("k"))


@query("SELECT c_custkey AS key FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def collection_difference(s: SparkSession, d: str) -> DataFrame:
    return sets.missing_keys(table(s, d, "customer").withColumnRenamed("c_custkey", "k"), table(s, d, "orders").filter("o_orderstatus = 'P'").withColumnRenamed("o_custkey", "k"), F.col("k"))


@query("SELECT p_brand, COUNT(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 10")
def scaffold_topk(s: SparkSession, d: str) -> DataFrame:
    return sets.top_groups(table(s, d, "part"), "p_brand", 10)


@query("SELECT toxic, COUNT(*) AS n, ROUND(COUNT(*) / (SELECT COUNT(*)::DOUBLE FROM labels), 3) AS share FROM labels GROUP BY 1")
def label_stats(s: SparkSession, d: str) -> DataFrame:
    return sets.label_shares(table(s, d, "labels"), "toxic")


# --- scores ------------------------------------------------------------------------------------


def _curve_sql(x: str, c: scoring.Curve) -> str:
    return f"(({c.a!r} + {c.b!r} / (1 + EXP(-(({x}) - {c.c!r} + {c.d!r} / 2) / {c.e!r})) * (1 - 1 / (1 + EXP(-(({x}) - {c.c!r} - {c.d!r} / 2) / {c.f!r})))) / {c.dmax!r})"


CURVE_COLUMNS = {"LogS": "c_acctbal / 1000 - 6", "LogP": "c_acctbal / 1500", "PPB": "c_acctbal / 100", "T1/2": "c_acctbal / 3000"}


@query("SELECT c_custkey, " + ", ".join(f"ROUND({_curve_sql(x, scoring.CURVES[k])}, 6) AS d{i}" for i, (k, x) in enumerate(CURVE_COLUMNS.items())) + " FROM customer")
def desirability_score(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "customer").select("c_custkey", *[F.expr(x).alias(k) for k, x in CURVE_COLUMNS.items()])
    return rows.select("c_custkey", *[F.round(scoring.desirability(k), 6).alias(f"d{i}") for i, k in enumerate(CURVE_COLUMNS)])


GEO_WEIGHTS = {"LogS": 0.9, "LogP": 0.7, "PPB": 0.5, "T1/2": 1.0}


@query("SELECT c_custkey, ROUND(EXP((" + " + ".join(f"{GEO_WEIGHTS[k]} * LN({_curve_sql(x, scoring.CURVES[k])})" for k, x in CURVE_COLUMNS.items()) + f") / {sum(GEO_WEIGHTS.values())!r}), 6) AS score FROM customer")
def weighted_geomean(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "customer").select("c_custkey", *[F.expr(x).alias(k) for k, x in CURVE_COLUMNS.items()])
    return rows.select("c_custkey", F.round(scoring.weighted_geomean({k: scoring.desirability(k) for k in GEO_WEIGHTS}, GEO_WEIGHTS), 6).alias("score"))


@query("WITH m AS (SELECT AVG(c_acctbal) mu, STDDEV_SAMP(c_acctbal) sd FROM customer) SELECT c_custkey, ROUND(1 / (1 + EXP(-(c_acctbal - mu) / sd)), 6) AS z FROM customer, m")
def zscore_sigmoid(s: SparkSession, d: str) -> DataFrame:
    return scoring.zscore_sigmoid(table(s, d, "customer"), "c_acctbal", "z").select("c_custkey", F.round("z", 6).alias("z"))


@query("SELECT p_partkey, ROUND(POWER(10, -p_size / 20.0) * p_retailprice * 1000, 4) AS ld50 FROM part")
def unit_conversion(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "part").select("p_partkey", F.round(scoring.lethal_dose(F.col("p_size") / F.lit(20.0), F.col("p_retailprice")), 4).alias("ld50"))


# --- similarity and clusters -------------------------------------------------------------------

BITS = 64


def _prints(s: SparkSession, d: str) -> DataFrame:
    flags = F.transform("embedding", lambda x: x > 0)
    return table(s, d, "embeddings").select(F.col("vec_id").alias("id"), "label", similarity.pack_bits(flags).alias("fp"), similarity.on_bits(flags).alias("bits"))


PRINTS_SQL = "fp AS (SELECT vec_id AS id, label, list_filter(range(64), lambda i: embedding[i + 1] > 0) AS bits FROM embeddings)"
SIM_SQL = "len(list_intersect(a.bits, b.bits))::DOUBLE / (len(a.bits) + len(b.bits) - len(list_intersect(a.bits, b.bits)))"


@query(f"WITH {PRINTS_SQL} SELECT a.id AS target, b.id AS query, ROUND({SIM_SQL}, 6) AS sim FROM fp a, fp b WHERE b.id % 20 = 0")
def similarity_matrix(s: SparkSession, d: str) -> DataFrame:
    fp = _prints(s, d)
    return similarity.similarity_matrix(fp, fp.filter("id % 20 = 0")).withColumn("sim", F.round("sim", 6))


@query(f"WITH {PRINTS_SQL} SELECT target, ROUND(CAST(SUM(CAST(ROUND(sim, 3) AS DECIMAL(18,3))) AS DOUBLE) / COUNT(*), 6) AS mean_sim FROM (SELECT a.id AS target, {SIM_SQL} AS sim FROM fp a, fp b WHERE b.id % 20 = 0) GROUP BY 1 HAVING CAST(SUM(CAST(ROUND(sim, 3) AS DECIMAL(18,3))) AS DOUBLE) / COUNT(*) > 0.33")
def mean_similarity_filter(s: SparkSession, d: str) -> DataFrame:
    fp = _prints(s, d)
    kept = similarity.mean_similarity_prints(fp, fp.filter("id % 20 = 0"), 0.33)
    return kept.select("target", F.round("mean_sim", 6).alias("mean_sim"))


@query(f"WITH {PRINTS_SQL} SELECT target, query, ROUND(sim, 6) AS sim FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY target ORDER BY sim DESC, query) rn FROM (SELECT a.id AS target, b.id AS query, {SIM_SQL} AS sim FROM fp a, fp b WHERE b.id % 20 = 0)) WHERE rn = 1")
def nearest_neighbour(s: SparkSession, d: str) -> DataFrame:
    fp = _prints(s, d)
    found = topk.nearest_prints(fp, fp.filter("id % 20 = 0"))
    return found.select("target", "query", F.round("sim", 6).alias("sim"))


@query(f"WITH {PRINTS_SQL} SELECT a.id AS a, b.id AS b, ROUND({SIM_SQL}, 6) AS sim FROM fp a, fp b WHERE a.id < b.id AND {SIM_SQL} >= 0.6")
def threshold_pairs(s: SparkSession, d: str) -> DataFrame:
    return similarity.dense_pairs(_prints(s, d).select("id", "fp"), 0.6).withColumn("sim", F.round("sim", 6))


@query(f"WITH {PRINTS_SQL} SELECT id, label FROM fp WHERE label = 0 UNION ALL SELECT id, label FROM fp b WHERE label <> 0 AND NOT EXISTS (SELECT 1 FROM fp a WHERE a.label = 0 AND {SIM_SQL} > 0.5)")
def ambiguity_removal(s: SparkSession, d: str) -> DataFrame:
    return similarity.drop_ambiguous(_prints(s, d).select("id", "label", "fp"), "label", 0, 0.5, similarity.dense_pairs).select("id", "label")


@query("""WITH w AS (SELECT item_id AS id, unnest(string_split(text, ' ')) AS key FROM benchmark), c AS (SELECT id, key, COUNT(*) AS n FROM w GROUP BY 1, 2), t AS (SELECT id, SUM(n) AS total FROM c GROUP BY 1)
SELECT x.id AS a, y.id AS b, ROUND(SUM(LEAST(x.n, y.n))::DOUBLE / (ANY_VALUE(tx.total) + ANY_VALUE(ty.total) - SUM(LEAST(x.n, y.n))), 6) AS sim FROM c x JOIN c y USING (key) JOIN t tx ON tx.id = x.id JOIN t ty ON ty.id = y.id WHERE y.id % 20 = 0 GROUP BY 1, 2""")
def count_tanimoto(s: SparkSession, d: str) -> DataFrame:
    words = table(s, d, "benchmark").select(F.col("item_id").alias("id"), F.explode(F.split("text", " ")).alias("key"))
    counts = words.groupBy("id", "key").agg(F.count("*").alias("n"))
    return similarity.count_tanimoto(counts, counts.filter("id % 20 = 0")).withColumn("sim", F.round("sim", 6))


@query(f"""WITH RECURSIVE {PRINTS_SQL}, e AS (SELECT a.id AS a, b.id AS b, {SIM_SQL} AS sim FROM fp a, fp b WHERE a.id <> b.id AND {SIM_SQL} >= 0.5),
r AS (SELECT id, ROW_NUMBER() OVER (ORDER BY COALESCE(deg, 0) DESC, id DESC) AS k FROM fp LEFT JOIN (SELECT a AS id, COUNT(*) AS deg FROM e GROUP BY 1) USING (id)),
nb AS (SELECT x.k, COALESCE(list(y.k) FILTER (y.k IS NOT NULL), []) AS near FROM r x LEFT JOIN e ON e.a = x.id LEFT JOIN r y ON y.id = e.b GROUP BY 1),
st AS (SELECT (SELECT list(near ORDER BY k) FROM nb) AS near, (SELECT COUNT(*) FROM r) AS n),
g AS (SELECT 1::BIGINT AS i, list_transform(range(1, n + 1), lambda j: NULL::BIGINT) AS c FROM st
  UNION ALL SELECT i + 1, CASE WHEN c[i] IS NULL THEN list_transform(range(1, n + 1), lambda j: CASE WHEN c[j] IS NULL AND (j = i OR list_contains(near[i], j)) THEN i ELSE c[j] END) ELSE c END FROM g, st WHERE i <= n),
f AS (SELECT unnest(range(1, n + 1)) AS k, unnest(c) AS c FROM g, st WHERE i = n + 1)
SELECT m.id AS member, h.id AS centroid, CASE WHEN m.id = h.id THEN 1.0 ELSE ROUND(e.sim, 6) END::DOUBLE AS sim FROM f JOIN r m ON m.k = f.k JOIN r h ON h.k = f.c LEFT JOIN e ON e.a = m.id AND e.b = h.id""")
def butina_clusters(s: SparkSession, d: str) -> DataFrame:
    return clustering.butina_prints(_prints(s, d).select("id", "fp"), 0.5).withColumn("sim", F.round("sim", 6))


# --- structures --------------------------------------------------------------------------------


def _points(s: SparkSession, d: str) -> DataFrame:
    at = lambda i: F.get("embedding", F.lit(i)).cast("double")
    return table(s, d, "embeddings").select(F.col("vec_id").alias("id"), "label", at(0).alias("x"), at(1).alias("y"), at(2).alias("z"))


POINTS_SQL = "pt AS (SELECT vec_id AS id, label, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings)"


@query(f"WITH {POINTS_SQL} SELECT label, " + ", ".join(f"ROUND((MAX({a}) + MIN({a})) / 2, 4) AS center_{a}" for a in "xyz") + ", " + ", ".join(f"ROUND(GREATEST(MAX({a}) - MIN({a}) + 0.1, 0.5), 4) AS size_{a}" for a in "xyz") + " FROM pt GROUP BY 1")
def bounding_box(s: SparkSession, d: str) -> DataFrame:
    return structure.bounding_box(_points(s, d), ["label"], 0.1, 0.5)


@query(f"WITH {POINTS_SQL} SELECT " + ", ".join(f"ROUND(CAST(SUM(CAST({a} AS DECIMAL(20,6))) AS DOUBLE) / COUNT(*), 4) AS center_{a}" for a in "xyz") + ", " + ", ".join(f"ROUND(MAX({a}) - MIN({a}) + 0.2, 4) AS size_{a}" for a in "xyz") + " FROM pt WHERE label BETWEEN 2 AND 5")
def pocket_box(s: SparkSession, d: str) -> DataFrame:
    return structure.pocket_box(_points(s, d).withColumnRenamed("label", "resnum"), 2, 5, 0.2)


@query(f"WITH {POINTS_SQL} SELECT a.id AS d, b.id AS a, ROUND(SQRT((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z)), 6) AS distance FROM pt a, pt b WHERE a.label < 5 AND b.label >= 5 AND (a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z) <= 0.05 * 0.05")
def range_contacts(s: SparkSession, d: str) -> DataFrame:
    p = _points(s, d)
    return structure.contacts(p.filter("label < 5"), p.filter("label >= 5"), 0.05).withColumn("distance", F.round("distance", 6))


@query("SELECT l_orderkey, COUNT(DISTINCT (LEAST(l_partkey, l_suppkey), GREATEST(l_partkey, l_suppkey))) AS n_pairs FROM lineitem GROUP BY 1")
def unordered_pair_count(s: SparkSession, d: str) -> DataFrame:
    return structure.unordered_pairs(table(s, d, "lineitem"), "l_orderkey", "l_partkey", "l_suppkey")


@query("SELECT l_orderkey AS ligand_name, COUNT(*) AS total_hbonds, COUNT(*) FILTER (s_nationkey IN (1, 2, 3)) AS key_residue_hbonds FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1")
def key_residue_counts(s: SparkSession, d: str) -> DataFrame:
    pairs = table(s, d, "lineitem").select(F.col("l_orderkey").alias("ligand_name"), F.col("l_suppkey").alias("atom_id"))
    atoms = table(s, d, "supplier").select(F.col("s_suppkey").alias("atom_id"), F.lit("A").alias("chain"), F.col("s_nationkey").alias("resnum"))
    return structure.hbond_counts(pairs, atoms, (1, 2, 3))


# --- sampling and splits -----------------------------------------------------------------------


@query("SELECT l_returnflag || l_linestatus AS shard, COUNT(*) AS n_rows, CAST(FLOOR(1000.0::DOUBLE / (SELECT COUNT(*) FROM lineitem) * COUNT(*)) AS BIGINT) AS n_sample FROM lineitem GROUP BY 1")
def shard_allocation(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("shard"))
    return sampling.allocate(sampling.shard_counts(rows, "shard"), 1000)


@query("WITH n AS (SELECT lang, COUNT(*) AS n FROM documents GROUP BY 1) SELECT lang, split, CAST(CASE split WHEN 'train' THEN n // 10 * 3 ELSE n // 10 END AS BIGINT) AS n, CAST(CASE split WHEN 'train' THEN n // 10 * 3 ELSE n // 10 END AS BIGINT) AS n_of_lang, n // 10 * 5 AS n_ids FROM n, (VALUES ('train'), ('valid'), ('test')) v(split) WHERE n >= 10")
def split_sizes(s: SparkSession, d: str) -> DataFrame:
    docs = table(s, d, "documents").select("doc_id", "lang")
    tenth = F.floor(F.col("n_rows") / 10).cast("bigint")
    sizes = sampling.shard_counts(docs, "lang").select("lang", (3 * tenth).alias("n_train"), tenth.alias("n_valid"), tenth.alias("n_test"))
    drawn = sampling.stratified_split(docs, "lang", "doc_id", sizes, 7).join(docs.select("doc_id", F.col("lang").alias("_lang")), "doc_id")
    ids = drawn.groupBy("lang").agg(F.countDistinct("doc_id").alias("n_ids"))
    return drawn.groupBy("lang", "split").agg(F.count("*").alias("n"), F.count_if(F.col("lang") == F.col("_lang")).alias("n_of_lang")).join(ids, "lang")


@query("""WITH sp AS (SELECT o_custkey AS id, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS r FROM orders), m AS (SELECT id, MIN(r) AS r FROM sp GROUP BY 1)
SELECT id, CASE r WHEN 1 THEN 'train' WHEN 2 THEN 'valid' ELSE 'test' END AS split FROM m WHERE id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def split_hygiene(s: SparkSession, d: str) -> DataFrame:
    split = F.when(F.col("o_orderstatus") == "F", "train").when(F.col("o_orderstatus") == "O", "valid").otherwise("test")
    splits = table(s, d, "orders").select(F.col("o_custkey").alias("id"), split.alias("split"))
    return dedup.split_hygiene(splits, history=table(s, d, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("id")))


@query("""WITH RECURSIVE c AS (SELECT source, COUNT(*) AS n, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, source) AS k FROM documents GROUP BY 1),
g AS (SELECT 0::BIGINT AS k, [0, 0, 0, 0, 0]::BIGINT[] AS load, NULL::BIGINT AS fold
  UNION ALL SELECT c.k, list_transform(range(5), lambda f: load[f + 1] + CASE WHEN f + 1 = list_position(load, list_min(load)) THEN c.n ELSE 0 END), list_position(load, list_min(load)) - 1 FROM g JOIN c ON c.k = g.k + 1)
SELECT source, n, fold::INTEGER AS fold FROM g JOIN c USING (k)""")
def group_kfold(s: SparkSession, d: str) -> DataFrame:
    return sampling.group_folds(table(s, d, "documents"), "source", 5)


@query("WITH c AS (SELECT toxic, COUNT(*) AS n, COUNT(DISTINCT doc_id) AS n_ids FROM labels GROUP BY 1), m AS (SELECT MAX(n) AS m FROM c) SELECT toxic, m AS n, n_ids, m // n AS least_copies, (m + n - 1) // n AS most_copies, m % n AS n_once_more FROM c, m")
def class_rebalance(s: SparkSession, d: str) -> DataFrame:
    copies = sampling.rebalance(table(s, d, "labels"), "toxic", "doc_id", 3).groupBy("toxic", "doc_id").agg(F.count("*").alias("c"))
    per = copies.groupBy("toxic").agg(F.sum("c").alias("n"), F.count("*").alias("n_ids"), F.min("c").alias("least_copies"), F.max("c").alias("most_copies"))
    return per.withColumn("n_once_more", F.col("n") - F.col("n_ids") * F.col("least_copies"))


# --- evaluation --------------------------------------------------------------------------------


def _scored(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "labels").join(table(s, d, "documents").select("doc_id", "n_chars"), "doc_id").select(F.col("n_chars").cast("double").alias("score"), F.col("quality").alias("label"), (F.col("n_chars") > 800).cast("int").alias("predicted"))


SCORED_SQL = "sc AS (SELECT n_chars::DOUBLE AS score, quality AS label, CAST(n_chars > 800 AS INTEGER) AS predicted FROM labels JOIN documents USING (doc_id))"


@query(f"WITH {SCORED_SQL}, g AS (SELECT score, SUM(label) p, COUNT(*) n FROM sc GROUP BY 1) SELECT score AS threshold, ROUND(SUM(p) OVER w::DOUBLE / SUM(n) OVER w, 6) AS precision, ROUND(SUM(p) OVER w / (SELECT SUM(p)::DOUBLE FROM g), 6) AS recall FROM g WINDOW w AS (ORDER BY score DESC)".replace("SUM(p) OVER w::DOUBLE", "(SUM(p) OVER w)::DOUBLE"))
def pr_curve(s: SparkSession, d: str) -> DataFrame:
    c = evaluation.pr_curve(_scored(s, d), "score", "label")
    return c.select("threshold", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


@query(f"WITH {SCORED_SQL} SELECT ROUND(SUM(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0 END)::DOUBLE / COUNT(*), 6) AS auc FROM sc a, sc b WHERE a.label = 1 AND b.label = 0")
def roc_auc(s: SparkSession, d: str) -> DataFrame:
    return evaluation.roc_auc(_scored(s, d), "score", "label").select(F.round("auc", 6).alias("auc"))


@query(f"""WITH {SCORED_SQL}, c AS (SELECT COUNT(*) FILTER (label = 1 AND predicted = 1) tp, COUNT(*) FILTER (label = 0 AND predicted = 1) fp, COUNT(*) FILTER (label = 0 AND predicted = 0) tn, COUNT(*) FILTER (label = 1 AND predicted = 0) fn FROM sc)
SELECT tp, fp, tn, fn, ROUND(tp / (tp + fn)::DOUBLE, 6) AS recall, ROUND(tp / (tp + fp)::DOUBLE, 6) AS precision, ROUND(2.0 * tp / (2 * tp + fn + fp)::DOUBLE, 6) AS f1, ROUND((tp::DOUBLE * tn - fp::DOUBLE * fn) / SQRT((tp + fp)::DOUBLE * (tp + fn) * (tn + fp) * (tn + fn)), 6) AS mcc FROM c""")
def confusion_metrics(s: SparkSession, d: str) -> DataFrame:
    c = evaluation.confusion(_scored(s, d), "label", "predicted")
    return c.select("tp", "fp", "tn", "fn", *[F.round(x, 6).alias(x) for x in ("recall", "precision", "f1", "mcc")])


@query("""WITH m AS (SELECT AVG(o_totalprice) mu, COUNT(*) n FROM orders), g AS (SELECT 1000 AS good), e AS (SELECT MAX(o_totalprice) AS edge FROM (SELECT o_totalprice FROM orders ORDER BY 1 LIMIT 1001)),
c AS (SELECT mu - CASE WHEN n > 1000 THEN GREATEST(1, CEIL((mu - edge) / 0.005)) ELSE 0 END * 0.005 AS cutoff FROM m, e) SELECT ROUND(cutoff, 2) AS cutoff, (SELECT COUNT(*) FROM orders, c WHERE o_totalprice < cutoff) AS n_below FROM c""")
def cutoff_search(s: SparkSession, d: str) -> DataFrame:
    return evaluation.lowered_cutoff(table(s, d, "orders"), "o_totalprice", 1000).select(F.round("cutoff", 2).alias("cutoff"), "n_below")


MODELS_SQL = """m AS (SELECT o_orderkey % 40 AS model_no, (o_orderkey % 4)::DOUBLE AS cutoff, ROUND(CAST(SUM(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) / COUNT(*) / 200000, 4) AS pr_te, ROUND(COUNT(*) FILTER (o_orderstatus = 'F') / COUNT(*)::DOUBLE, 4) AS re_te FROM orders GROUP BY 1, 2)"""


@query(f"WITH {MODELS_SQL}, r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY cutoff ORDER BY re_te DESC) i, COUNT(*) OVER (PARTITION BY cutoff) n FROM m), t AS (SELECT cutoff, 0.9 - 0.01 * GREATEST(0, CEIL(ROUND((0.9 - re_te) / 0.01, 9))) AS thr FROM r WHERE i = n // 4 + 1) SELECT cutoff, ROUND(thr, 6) AS thr FROM t")
def recall_relaxation(s: SparkSession, d: str) -> DataFrame:
    return evaluation.recall_cutoff(_models(s, d), 0.9).select("cutoff", F.round("thr", 6).alias("thr"))


def _models(s: SparkSession, d: str) -> DataFrame:
    o = table(s, d, "orders")
    mean = F.sum(F.col("o_totalprice").cast("decimal(18,4)")).cast("double") / F.count("*") / 200000
    return o.groupBy((F.col("o_orderkey") % 40).alias("model_no"), (F.col("o_orderkey") % 4).cast("double").alias("cutoff")).agg(F.round(mean, 4).alias("pr_te"), F.round(F.count_if(F.col("o_orderstatus") == "F") / F.count("*"), 4).alias("re_te"))


@query(f"WITH {MODELS_SQL} SELECT cutoff, model_no, pr_te FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY cutoff ORDER BY pr_te DESC, model_no) rn FROM m) WHERE rn <= 3")
def model_selection(s: SparkSession, d: str) -> DataFrame:
    models = _models(s, d).withColumns({"re_vl": F.col("pr_te") + F.col("model_no") % 3, "re_pr": F.lit(1.0), "re_te": F.lit(0.95)})
    return evaluation.select_models(models, 0.9).select("cutoff", "model_no", "pr_te")


@query("SELECT s_suppkey AS target, a.v AS n_layers, b.v AS n_units, c.v AS dropout, d.v AS class_weight FROM supplier, (VALUES (2::BIGINT), (3)) a(v), (VALUES (1500::BIGINT), (2000)) b(v), (VALUES (0.2::DOUBLE), (0.5)) c(v), (VALUES (2.0::DOUBLE), (3.0)) d(v)")
def hyper_grid(s: SparkSession, d: str) -> DataFrame:
    """The settings to try for each target."""
    targets = table(s, d, "supplier").select(F.col("s_suppkey").alias("target"))
    return evaluation.grids_for(targets, evaluation.hyper_grid(s)).select("target", "n_layers", "n_units", "dropout", "class_weight")


@query("WITH p AS (SELECT s_name AS node, GREATEST((s_suppkey % 16) * 1.5 - (s_nationkey % 9), 0)::DOUBLE * (1 + s_suppkey % 2) AS power FROM supplier) SELECT node, power, CAST(ROUND_EVEN(60 * power / ((SELECT SUM(power) FROM p) * 0.6), 0) AS INTEGER) AS slots FROM p")
def slot_allocation(s: SparkSession, d: str) -> DataFrame:
    nodes = table(s, d, "supplier").select(F.col("s_name").alias("node"), (F.col("s_suppkey") % 16).alias("ncpu"), (F.col("s_nationkey") % 9).alias("load"), (1 + F.col("s_suppkey") % 2).alias("factor"), F.lit(60).alias("wanted"))
    return resources.slots(nodes).select("node", "power", "slots")


@query("SELECT s_name AS gpu_id, s_nationkey % 2 + 1 AS host, CAST(s_suppkey * 37 % 100 AS BIGINT) AS util FROM supplier WHERE 24576 - s_suppkey * 977 % 24000 > 10000 AND s_suppkey * 37 % 100 < 70 ORDER BY host DESC, util, gpu_id LIMIT 4")
def gpu_pick(s: SparkSession, d: str) -> DataFrame:
    gpus = table(s, d, "supplier").select(F.col("s_name").alias("gpu_id"), (F.col("s_nationkey") % 2 + 1).alias("host"), (F.col("s_suppkey") * 977 % 24000).alias("used_mb"), (F.col("s_suppkey") * 37 % 100).alias("util"))
    return resources.free_gpus(gpus, 4).select("gpu_id", "host", "util")


# --- log ---------------------------------------------------------------------------------------


def _log(s: SparkSession, d: str) -> DataFrame:
    module = F.get(F.array(*map(F.lit, progress.MODULES)), F.least(F.lit(7), F.floor(F.col("event_id") * 8 / 12000)).cast("int"))
    message = (
        F.when(F.col("event_type") == "signup", F.concat(F.lit("MODULE "), module, F.lit(": start")))
        .when(F.col("event_type") == "click", F.format_string("%d%% %d:100=5s", F.col("event_id") % 100, F.col("event_id")))
        .when(F.col("event_type") == "purchase", F.format_string("Batch 1 size: %d", F.col("event_id") % 300))
        .otherwise(F.concat(F.lit("error at "), F.col("event_id").cast("string")))
    )
    return table(s, d, "events").select(F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"), F.lit("info").alias("level"), message.alias("message"))


@query("SELECT CAST(SUM(event_id % 300) AS BIGINT) AS done, CAST(LEAST(100, FLOOR(SUM(event_id % 300) * 100 / 500000.0)) AS INTEGER) AS percent FROM events WHERE event_type = 'purchase'")
def progress_running_sum(s: SparkSession, d: str) -> DataFrame:
    return progress.batches_done(_log(s, d), 500_000)


@query("SELECT CAST(event_id % 100 AS INTEGER) AS percent FROM events WHERE event_type = 'click' ORDER BY event_id DESC LIMIT 1")
def progress_percent(s: SparkSession, d: str) -> DataFrame:
    return progress.latest_percent(_log(s, d))


@query("""WITH m AS (SELECT event_id, LEAST(7, event_id * 8 // 12000) AS k FROM events WHERE event_type = 'signup'), g AS (SELECT k, MIN(event_id) AS first_seq, MAX(event_id) AS last FROM m GROUP BY 1)
SELECT ['library', 'receptor', 'physchem', 'admet', 'druglikeness', 'prepare_ligand', 'docking', 'results'][k + 1] AS module, first_seq, last <> (SELECT MAX(last) FROM g) AS completed, CAST(k * 100 // 7 AS INTEGER) AS progress FROM g""")
def module_transitions(s: SparkSession, d: str) -> DataFrame:
    return progress.transitions(_log(s, d))


@query("SELECT event_id AS seq, event_type FROM events ORDER BY event_id DESC LIMIT 1000")
def log_tail(s: SparkSession, d: str) -> DataFrame:
    return progress.log_tail(table(s, d, "events").select(F.col("event_id").alias("seq"), "event_type"))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, LAG(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS b FROM events) WHERE b IS DISTINCT FROM event_type")
def repeat_suppression(s: SparkSession, d: str) -> DataFrame:
    return dedup.without_repeats(table(s, d, "events"), ["user_id"], "event_id", "event_type").select("user_id", "event_id", "event_type")


@query("SELECT TIME_BUCKET(INTERVAL 1 HOUR, ts) AS window_start, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2")
def streaming_tumbling(s: SparkSession, d: str) -> DataFrame:
    return progress.tumbling_counts(table(s, d, "events"), "1 hour").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("SELECT TIME_BUCKET(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE * k AS window_start, event_type, COUNT(*) AS n FROM events, (VALUES (0), (1)) o(k) GROUP BY 1, 2")
def streaming_sliding(s: SparkSession, d: str) -> DataFrame:
    return progress.sliding_counts(table(s, d, "events"), "1 hour", "30 minutes").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("""WITH e AS (SELECT user_id, ts, CASE WHEN ts >= LAG(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR OR LAG(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL THEN 1 ELSE 0 END AS fresh FROM events),
g AS (SELECT *, SUM(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e) SELECT MIN(ts) AS session_start, user_id, COUNT(*) AS n FROM g GROUP BY user_id, k""")
def streaming_session(s: SparkSession, d: str) -> DataFrame:
    return progress.session_counts(table(s, d, "events"), "6 hours").withColumn("session_start", F.col("session_start").cast("timestamp_ntz"))


@query("""WITH e AS (SELECT user_id, event_id, value, MAX(value) OVER (PARTITION BY user_id ORDER BY event_id) AS best FROM events) SELECT user_id, MAX(best) AS best, COUNT(*) FILTER (event_id > (SELECT MAX(f.event_id) FROM e f WHERE f.user_id = e.user_id AND f.value = f.best)) AS waited FROM e GROUP BY 1""")
def early_stopping(s: SparkSession, d: str) -> DataFrame:
    series = evaluation.best_so_far(table(s, d, "events"), "event_id", "value", by=["user_id"])
    return series.groupBy("user_id").agg(F.max("best").alias("best"), F.max_by("waited", "event_id").alias("waited"))


# --- funnel -------------------------------------------------------------------


@query(f"""WITH {DOCK_SQL}, l0 AS (SELECT p_partkey AS name FROM part WHERE NOT contains(p_name, '.')),
l1 AS (SELECT name FROM l0 SEMI JOIN (SELECT name FROM props WHERE (CASE WHEN MW BETWEEN 310 AND 330 THEN 1 ELSE 0 END + CASE WHEN LogP BETWEEN 0.5 AND 4 THEN 1 ELSE 0 END + CASE WHEN nHA <= 10 THEN 1 ELSE 0 END + CASE WHEN nHD <= 4 THEN 1 ELSE 0 END + CASE WHEN nRot <= 9 THEN 1 ELSE 0 END) >= 3) USING (name)),
l2 AS (SELECT name FROM l1 SEMI JOIN (SELECT name FROM ad WHERE admet_score >= 0.0) USING (name)),
l3 AS (SELECT name FROM l2 SEMI JOIN (SELECT name FROM votes WHERE {VOTE_SQL} >= 1) USING (name)),
l4 AS (SELECT name FROM l3 SEMI JOIN (SELECT name FROM hb WHERE key_residue_hbonds > 0) USING (name))
SELECT 0 AS step, 'library' AS module, COUNT(*) AS n FROM l0 UNION ALL SELECT 1, 'physchem', COUNT(*) FROM l1 UNION ALL SELECT 2, 'admet', COUNT(*) FROM l2 UNION ALL SELECT 3, 'druglikeness', COUNT(*) FROM l3 UNION ALL SELECT 4, 'docking', COUNT(*) FROM l4""")
def funnel(s: SparkSession, d: str) -> DataFrame:
    config = Config(physchem=BOUNDS, physchem_least=3, admet={"score": (0.0, None)}, votes_least=1)
    library = table(s, d, "part").select(F.col("p_partkey").alias("name"), F.col("p_name").alias("smiles"))
    state = Screening(config, library, _props(s, d), _admet(s, d).withColumnRenamed("admet_score", "score"), _votes(s, d), _dock(s, d), _hbonds(s, d))
    return funnel_counts(s, state.funnel())
