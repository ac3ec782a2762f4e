"""Quality rules combined by weak supervision (DataFrame and SQL functions only).

Each rule looks at one statistic of a document and votes good (1), bad (-1) or
abstains (0). Votes form a pattern; there are at most 2 * 3 ** 9 patterns,
however many documents there are. Expectation-maximisation over the counted
patterns estimates each rule's accuracy on good and on bad documents, and the
posterior of a pattern decides about every document that has it.

Defined results: null text counts as empty; an empty text has no words, fails
the base rules and is not kept. An empty table gives an empty result. Repeated
rows are judged alike. Other columns of the input are ignored by
:func:`quality_verdicts` and kept untouched by :func:`filter_quality`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
EM_ROUNDS = 40
#: Where EM starts, and a prior worth PRIOR_VOTES votes: a rule seldom objects to a
#: good document, and sees a defect in three bad documents out of ten.
PRIOR_VOTES = 20.0
GOOD_ACCURACY, GOOD_LEAST = 0.995, 0.99
BAD_ACCURACY, BAD_LEAST = 0.3, 0.05
PRIOR_GOOD = 0.8


def _band(value: Column, bad: Column, good: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))


def _ratio(a: Column, b: Column) -> Column:
    return a / F.greatest(b, F.lit(1))


def rules() -> dict[str, Column]:
    """The voting rules. A rule that has no evidence abstains."""
    c = F.col
    words = c("n_words")
    length = _ratio(c("word_chars"), words)
    symbols = _ratio(c("n_symbols"), words)
    marks = _ratio(c("n_symbols"), c("word_chars"))
    upper = _ratio(c("n_upper"), c("word_chars"))
    shout = _ratio(c("n_shouts"), words)
    repeat = _ratio(c("n_repeat_words"), words)
    lines = _ratio(c("n_dup_lines"), c("n_lines"))
    variety = _ratio(c("n_distinct_words"), words)
    ends = _ratio(c("n_sentences"), words)
    return {
        "word_length": _band(length, (length < 2) | (length > 14), (length >= 3) & (length <= 11)),
        "few_symbols": _band(symbols, symbols > 0.1, symbols < 0.02),
        "mostly_letters": _band(marks, marks > 0.02, marks < 0.005),
        "no_shouting": _band(shout, shout > 0.1, shout < 0.02),
        "lower_case": _band(upper, upper > 0.3, upper < 0.12),
        "no_repeats": _band(repeat, repeat > 0.35, repeat < 0.2),
        "new_lines": _band(lines, lines > 0.5, lines < 0.2),
        "variety": _band(variety, variety < F.when(words < 1000, 0.3).otherwise(0.1), variety > 0.4),
        "sentences": _band(ends, ends < 0.002, ends > 0.02),
    }


def statistics(text: Column, docs: DataFrame, keep: list[Column]) -> DataFrame:
    """Whole-text statistics; ``keep`` are the columns carried along.

    Windows are compared by a 64-bit hash of their three words; two different
    windows of one text meet with a chance under n * n / 2 ** 64.
    """
    count_of = lambda t, chars: F.length(t) - F.length(reduce(lambda s, x: F.replace(s, F.lit(x), F.lit("")), chars, t))
    base = docs.select(*keep, F.coalesce(text, F.lit("")).alias("_t"))
    base = base.withColumn("_w", F.array_remove(F.split("_t", SPACE), ""))
    base = base.withColumn("_n", F.size("_w"))
    base = base.withColumn("_lines", F.filter(F.split("_t", "\n", -1), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    base = base.withColumn(
        "_h",
        F.when(
            F.col("_n") >= 3,
            F.transform(F.sequence(F.lit(0), F.col("_n") - 3), lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2))),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    base = base.select(
        *[F.col(c) for c in base.columns if c not in ("_t", "_w", "_h", "_lines")],
        F.col("_n").cast("long").alias("n_words"),
        count_of(F.col("_t"), []).alias("_zero"),
        (F.length("_t") - count_of(F.col("_t"), [" ", "\t", "\n", "\x0b", "\x0c", "\r"])).cast("long").alias("word_chars"),
        count_of(F.col("_t"), list(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("_w")).cast("long").alias("n_distinct_words"),
        F.regexp_count("_t", F.lit("\\p{Lu}")).cast("long").alias("n_upper"),
        count_of(F.col("_t"), ["!"]).cast("long").alias("n_shouts"),
        count_of(F.col("_t"), list(".?")).cast("long").alias("n_sentences"),
        F.when(F.size(F.array_distinct("_h")) < F.size("_h"), F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        .otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
        .alias("_hi"),
    ).drop("_zero", "_n")
    base = base.withColumn("_s", F.sort_array("_hi"))
    twice = F.filter("_s", lambda x, i: (x["h"] == F.get("_s", i - 1)["h"]) | (x["h"] == F.get("_s", i + 1)["h"]))
    base = base.withColumn("_p", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(
        "_p",
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    return base.withColumn("n_repeat_words", covered.cast("long")).drop("_hi", "_s", "_p")


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _pattern() -> Column:
    """Whether the base rules fail, then the votes. An array is never null, so that Spark derives no filter
    from a join on it, which would work the statistics out once more for each place that names them."""
    return F.array(_base_failed().cast("int"), *[v.cast("int") for v in rules().values()])


def _log_odds(votes: Column, model: Column) -> Column:
    """Log-odds of good for a vote pattern; abstentions add nothing."""
    terms = F.zip_with(
        votes,
        model["terms"],
        lambda v, t: F.when(v == 1, t["good"]).when(v == -1, t["bad"]).otherwise(F.lit(0.0)),
    )
    return model["prior"] + F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)


def accuracy_model(patterns: DataFrame) -> DataFrame:
    """EM over (votes, n) rows; one row with ``model``: prior log-odds and, per rule,
    what a good and a bad vote add to the log-odds.

    A bad document need show only one defect, so most rules vote good even on
    bad documents; the bounds keep the classes from changing places.
    """
    n_rules = len(rules())
    idx = F.sequence(F.lit(0), F.lit(n_rules - 1))

    def model_of(prior: Column, good: Column, bad: Column) -> Column:
        return F.struct(
            F.log(prior / (1 - prior)).alias("prior"),
            F.zip_with(
                good,
                bad,
                lambda g, b: F.struct(F.log(g / (1 - b)).alias("good"), F.log((1 - g) / b).alias("bad")),
            ).alias("terms"),
        )

    def step(model: Column) -> Column:
        weighted = F.transform(
            F.col("_patterns"),
            lambda p: F.struct(p["votes"].alias("v"), p["n"].alias("n"), (p["n"] / (1 + F.exp(-_log_odds(p["votes"], model)))).alias("g")),
        )

        def estimate(w: Column) -> Column:
            total = F.aggregate(w, F.lit(0.0), lambda a, x: a + x["n"])
            good = F.aggregate(w, F.lit(0.0), lambda a, x: a + x["g"])
            prior = F.least(F.greatest((good + 1) / (total + 2), F.lit(0.02)), F.lit(0.98))

            def rate(mine, vote, start, least):  # noqa: ANN001
                votes_of = lambda r, wanted: F.aggregate(w, F.lit(0.0), lambda a, x: a + F.when(wanted(F.get(x["v"], r)), mine(x)).otherwise(F.lit(0.0)))
                share = lambda r: (PRIOR_VOTES * start + votes_of(r, lambda v: v == vote)) / (PRIOR_VOTES + votes_of(r, lambda v: v != 0))
                return F.transform(idx, lambda r: F.least(F.greatest(share(r), F.lit(least)), F.lit(0.999)))

            good_rates = rate(lambda x: x["g"], 1, GOOD_ACCURACY, GOOD_LEAST)
            bad_rates = rate(lambda x: x["n"] - x["g"], -1, BAD_ACCURACY, BAD_LEAST)
            return model_of(prior, good_rates, bad_rates)

        return F.element_at(F.transform(F.array(weighted), estimate), 1)

    start = model_of(F.lit(PRIOR_GOOD), F.array_repeat(F.lit(GOOD_ACCURACY), n_rules), F.array_repeat(F.lit(BAD_ACCURACY), n_rules))
    gathered = patterns.agg(F.collect_list(F.struct(F.col("_votes").alias("votes"), F.col("_n").cast("double").alias("n"))).alias("_patterns"))
    gathered = gathered.select(F.sort_array("_patterns").alias("_patterns"), start.alias("_start"))
    return gathered.select(F.aggregate(F.sequence(F.lit(1), F.lit(EM_ROUNDS)), F.col("_start"), lambda m, _: step(m)).alias("model"))


def _pattern_verdicts(patterns: DataFrame) -> DataFrame:
    """(_pattern, _posterior, _kept) for each pattern that occurs: at most 2 * 3 ** len(rules()) rows.

    The model is learned from the documents that pass the base rules, as only those are judged by it.
    """
    from siftspark.session import checkpointed

    passed = F.get("_pattern", F.lit(0)) == 0
    counted = patterns.groupBy("_pattern").agg(F.count("*").alias("_n"))
    counted = checkpointed(counted.select("_pattern", F.slice("_pattern", 2, len(rules())).alias("_votes"), F.when(passed, F.col("_n")).otherwise(0).alias("_n")))
    posterior = 1 / (1 + F.exp(-_log_odds(F.col("_votes"), F.col("model"))))
    judged = counted.crossJoin(F.broadcast(accuracy_model(counted))).select("_pattern", posterior.alias("_posterior"))
    return judged.withColumn("_kept", passed & (F.col("_posterior") >= 0.5))


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """One row per document: its statistics, ``base_failed``, ``posterior`` and ``kept``.

    ``kept`` is false for documents that fail the base rules, else it says
    whether the posterior of good quality is at least one half.
    """
    from siftspark.session import checkpointed

    stats = checkpointed(statistics(F.col("text"), docs, [F.col("doc_id")]).withColumn("_pattern", _pattern()))
    verdicts = F.broadcast(_pattern_verdicts(stats.select("_pattern")))
    return stats.join(verdicts, "_pattern").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        _base_failed().alias("base_failed"),
        F.col("_kept").alias("kept"),
        F.round("_posterior", 6).alias("posterior"),
    )


def filter_quality(docs: DataFrame) -> DataFrame:
    """The documents that :func:`quality_verdicts` keeps, with all their columns.

    The statistics cost far more than a copy of the rows, so each row is written once with its pattern.
    """
    from siftspark.session import checkpointed

    row = docs.select(F.struct("*").alias("_row"))
    scored = checkpointed(statistics(F.col("_row.text"), row, [F.col("_row")]).select("_row", _pattern().alias("_pattern")))
    kept = checkpointed(_pattern_verdicts(scored.select("_pattern"))).filter("_kept").select("_pattern")
    return scored.join(F.broadcast(kept), "_pattern").select("_row.*")
