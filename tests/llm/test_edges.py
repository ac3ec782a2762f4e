"""Every operator and stage on nulls, empty and long texts, repeats, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from siftspark.llm import decontaminate, katz, line_dedup, mixing, pii, quality_model, quality_rules, simhash, toxicity, url_filter

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, kept string, _row int, removed string, fp int, held_out string"
PROSE = "the quick brown fox jumps over the lazy dog and then it runs through a quiet field of tall grass until evening comes. "
LABELS = "doc_id bigint, quality int, toxic int"


@pytest.fixture(scope="module")
def docs(spark):
    texts = [None, "", " \n\t", PROSE * 5, PROSE * 5, "you stupid idiot", "x" * 50_000, (PROSE * 400) + "\n" + PROSE, "é ü ß 漢字 🙂 " * 20, "a\n\nb\na", "## ## " * 30]
    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else "src1", None, 1.0, "k", i, "r", 0, "h") for i, t in enumerate(texts)]
    rows += [rows[3], (None, "no id here", "en", "src1", 3, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, int(i == 5)) for i in range(11)] + [(None, 1, 1), (3, None, None), (3, 1, 0)], LABELS)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, PROSE), (2, None), (None, PROSE), (3, "short"), (4, PROSE)], "item_id bigint, text string")


OPERATORS = {
    "mixing": lambda d, la, it: mixing.mix_documents(d),
    "leaks": lambda d, la, it: decontaminate.leaks(d, it),
    "pii": lambda d, la, it: pii.pseudonymise(d),
    "quality_model": lambda d, la, it: quality_model.quality_scores(d, la),
    "katz": lambda d, la, it: katz.language_scores(d),
    "lines": lambda d, la, it: line_dedup.line_verdicts(d),
    "simhash": lambda d, la, it: simhash.near_duplicates(d),
    "quality_rules": lambda d, la, it: quality_rules.quality_verdicts(d),
    "toxicity": lambda d, la, it: toxicity.toxicity_scores(d, la),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_per_document(docs, labels, items, name):
    got = OPERATORS[name](docs, labels, items)
    got = got.toPandas()
    assert len(got) == 13
    twins = got[got.doc_id == 3].drop(columns=[c for c in got.columns if got[c].map(lambda v: isinstance(v, (list, dict))).any()])
    assert len(twins) == 2 and len(twins.drop_duplicates()) == 1
    assert got.doc_id.isna().sum() == 1
    for column in ("score", "posterior", "rate", "base_score"):
        if column in got:
            assert got[column].notna().all()


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(docs, labels, items, name):
    assert OPERATORS[name](docs.limit(0), labels.limit(0), items.limit(0)).count() == 0


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:-1]], ids=[n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns(spark, docs, items, stage, tmp_path):
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    for table in (docs, docs.limit(0)):
        got = stage(spark, table, str(tmp_path))
        assert got.columns == docs.columns
        assert got.count() <= 13


def test_last_stage_adds_the_sampling_columns(docs):
    got = mixing.sample_documents(docs.withColumn("mix_rate", F.lit("old")))
    assert got.columns == [*docs.columns, "mix_rate", "mix_copies"] and dict(got.dtypes)["mix_rate"] == "double"
    assert mixing.sample_documents(docs.limit(0)).count() == 0


def test_urls(spark):
    pages = spark.createDataFrame([(1, None, 0.1), (2, "", 0.1), (3, "no scheme", 0.1), (4, "http://A.Example.COM/en/x?y=1&z=2#f", 0.1), (4, "http://A.Example.COM/en/x?y=1&z=2#f", 0.1), (5, "ftp://x", 0.1)], "page_id bigint, url string, host double")
    got = {r.page_id: r for r in url_filter.url_verdicts(pages).collect()}
    assert (got[1].host, got[1].path, got[1].rule) == ("", "", None) and got[3].host == ""
    assert (got[4].host, got[4].path, got[4].rule, got[4].verdict) == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert got[5].path == "" and got[5].verdict == "block"  # the only class that the rules have shown
    assert url_filter.url_verdicts(pages.limit(0)).count() == 0


def test_columns_that_clash_with_features(spark):
    names = ["label", "rule", "verdict", "weight", "path", "url_length", "entropy", "_suffix1", "_f", "_rows", "block_probability", "_features"]
    rows = [(i, f"http://{h}/x{i}", *(["q"] * len(names))) for i, h in enumerate(["a.com", "b.net", "example.com", "c.org"] * 5)]
    pages = spark.createDataFrame(rows, "page_id int, url string, " + ", ".join(f"{n} string" for n in names))
    plain = {r.page_id: tuple(r) for r in url_filter.url_verdicts(pages.select("page_id", "url")).collect()}
    assert {r.page_id: tuple(r) for r in url_filter.url_verdicts(pages).collect()} == plain and len(plain) == 20


def test_scores_at_the_threshold(docs, labels):
    for scores, params, m in ((quality_model.quality_scores, quality_model.Params, quality_model), (toxicity.toxicity_scores, toxicity.Params, toxicity)):
        some = sorted({r.score for r in scores(docs, labels).collect()})
        tie = some[len(some) // 2]
        got = scores(docs, labels, params(threshold=tie)).collect()
        assert all(r.predicted == int(r.score >= tie) for r in got) and any(r.score == tie and r.predicted for r in got)


def test_lines_of_texts_with_one_id(spark):
    line = "one two three four five six"
    rows = [(1, f"{line}\nalpha"), (1, f"beta\n{line}"), (1, f"{line}\nalpha"), (2, f"{line} seven"), (None, "alpha\nnull"), (0, "beta")]
    got = sorted((r.doc_id or -1, r.n_lines, list(r.removed)) for r in line_dedup.line_verdicts(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    # The null id comes first, then 0; the twins of id 1 are judged alike, and the second line of their sibling repeats their first.
    assert got == [(-1, 1, []), (-1, 2, []), (1, 2, [0, 1]), (1, 2, [1]), (1, 2, [1]), (2, 1, [0])]


def test_marginals_of_the_mix(docs):
    rows = {(r.axis, r.category): (r.target, r.fitted) for r in mixing.fitted_marginals(docs).collect()}
    assert abs(sum(f for (axis, _), (_, f) in rows.items() if axis == "lang") - 1) < 1e-6
    assert rows["source", "src5"][1] == 0  # no document of it
