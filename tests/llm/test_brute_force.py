"""Results that SQL cannot give, against plain Python on small tables."""

import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from siftspark.llm import decontaminate, line_dedup, mixing, pii, quality_model, quality_rules, simhash, toxicity, url_filter
from siftspark.session import table

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, DATA, "documents")


@pytest.fixture(scope="module")
def labels(spark):
    return table(spark, DATA, "labels")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}


def held_out(i, folds, fold):
    return zlib.crc32(str(i).encode()) % folds == fold


# --- op2 ---------------------------------------------------------------------------------------


def test_repeated_words_stay_cheap():
    seeds = decontaminate.Seeds([(1, "word " * 300)], decontaminate.Params())
    batch = pa.record_batch([pa.array(["word " * 60_000 + "end"])], names=["text"])
    began = time.time()
    n, hits = decontaminate._scan(batch, seeds, decontaminate.Params())
    assert n.tolist() == [60_001] and list(decontaminate._stretches(hits)) == [((0, 0), (0, 60_001))]
    assert time.time() - began < 60


def test_blocks_give_what_one_block_gives(spark, docs):
    bench = table(spark, DATA, "benchmark")
    one = {r.doc_id: (r.n_tokens, r.spans) for r in decontaminate.leaks(docs, bench).collect()}
    many = decontaminate.Params(block_chars=2_000)
    assert {r.doc_id: (r.n_tokens, r.spans) for r in decontaminate.leaks(docs, bench, many).collect()} == one
    assert {r.doc_id for r in decontaminate.drop_leaks(docs, bench, many).collect()} == {i for i, (_, s) in one.items() if not s}
    none = decontaminate.leaks(docs, bench.limit(0), many).collect()
    assert {r.doc_id: r.n_tokens for r in none} == {i: n for i, (n, _) in one.items()}


# --- op3 ---------------------------------------------------------------------------------------


def test_values_go_back_and_never_meet(spark, docs, texts):
    """Over a whole table: what a value becomes depends on the value alone, differs between values, and leads back."""
    image, back = {}, {}
    for t in texts.values():
        for m in pii.PATTERN.finditer(t):
            kind, value = m.lastgroup, m[0]
            new = pii.pseudonym(kind, value, b"key")
            if new is None:
                continue
            assert image.setdefault((kind, value), new) == new and back.setdefault((kind, new), value) == value
            assert pii.pseudonym(kind, new, b"key", back=True) == value
            assert [c.isdigit() for c in value] == [c.isdigit() for c in new] or kind in ("ip", "email", "secret", "iban")
    assert len(image) > 15
    params = pii.Params(key=b"key")
    for r in pii.pseudonymise(docs, params).collect():
        want, found = pii.pseudonymised(texts[r.doc_id], b"key")
        assert (r.text or "") == want and r.n_values == sum(found.values())
        for m in pii.PATTERN.finditer(texts[r.doc_id]):
            new = image.get((m.lastgroup, m[0]))
            if new is not None and new != m[0]:
                assert new in r.text


# --- op4 ---------------------------------------------------------------------------------------


def plain_statistics(t):
    w = WORD.findall(t)
    n, chars = len(w), sum(map(len, w))
    some = lambda x: math.log(x + 1e-3)
    count = lambda s: sum(t.count(c) for c in s)
    upper = sum("A" <= c <= "Z" or "À" <= c <= "Þ" for c in t)
    windows = [tuple(w[i : i + 3]) for i in range(n - 2)]
    lines = [x for x in t.split("\n") if x]
    top = max(Counter(w).values(), default=0)
    return [
        math.log1p(n), chars / max(n, 1), some(count("#*$%&|<>") / max(chars, 1)), some(t.count("!") / max(n, 1)), some(upper / max(chars, 1)),
        some(count("0123456789") / max(chars, 1)), math.log1p(len(set(w))) / math.log1p(max(n, 1)), some(sum(a == b for a, b in zip(w, w[1:], strict=False)) / max(n, 1)),
        some((len(windows) - len(set(windows))) / max(len(windows), 1)), some(top / max(n, 1)), some((len(lines) - len(set(lines))) / max(len(lines), 1)),
        math.log1p(n / max(len(lines), 1)), some(count(".?") / max(n, 1)), some(count(",;") / max(n, 1)),
    ]


def test_discriminant_equals_plain_numpy(docs, labels, texts):
    p = quality_model.Params()
    x = {i: np.array(plain_statistics(t)) for i, t in texts.items()}
    y = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None and r.doc_id in x and not held_out(r.doc_id, 4, 2)}
    groups = {k: np.array([x[i] for i in y if y[i] == k]) for k in (0, 1)}
    cov = {k: np.cov(g.T, bias=True) for k, g in groups.items()}
    n = {k: len(g) for k, g in groups.items()}
    pooled = np.diag(sum(n[k] * np.diag(cov[k]) for k in n) / sum(n.values()))
    ridge = p.ridge * (pooled + 1e-6 * np.eye(len(pooled)))
    got = {r.doc_id: r for r in quality_model.quality_scores(docs, labels).collect()}
    assert set(got) == set(texts)
    for i, v in x.items():
        odds = math.log((n[1] + 1) / (n[0] + 1))
        for k, sign in ((0, 0.5), (1, -0.5)):
            s = (1 - p.shrinkage) * cov[k] + p.shrinkage * pooled + ridge
            d = v - groups[k].mean(0)
            odds += sign * (d @ np.linalg.solve(s, d) + np.linalg.slogdet(s)[1])
        want = 1 / (1 + math.exp(-min(max(odds, -30), 30)))
        assert math.isclose(got[i].score, want, rel_tol=1e-5, abs_tol=1e-9)
        assert got[i].predicted == int(got[i].score >= 0.7) and got[i].held_out == held_out(i, 4, 2)


# --- op6 ---------------------------------------------------------------------------------------


def entropy(s):
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values()) if s else 0.0


def test_lexical_features_equal_plain_python(spark):
    urls = ["http://a-b.example.org/p1/q?x=1&y=2#z", "https://1.2.3.4/", "no scheme", "", "ftp://H.net", "http://x.org/?a", "http://x.org/#?a=1&b", "http://é.org/ü/ñ?k"]
    base = url_filter.lexical(url_filter.with_rule(url_filter.parsed(spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")), {}))
    for r in base.collect():
        u = urls[r.page_id]
        rest = u.split("://", 1)[1] if "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0].translate(TO_LOWER)
        path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
        query = re.match(r"[^?#]*\?([^#]*)", u)
        share = lambda s: sum(c in "0123456789" for c in s) / len(s) if s else 0.0
        segments = path.split("/")
        assert (r.host, r.path) == (host, path)
        assert (r.url_length, r.host_length, r.path_length, r.depth) == (len(u), len(host), len(path), sum(bool(s) for s in segments))
        assert (r.hyphens, r.has_query, r.has_fragment) == (host.count("-"), float("?" in u), float("#" in u))
        assert r.n_params == (0 if not query or not query[1] else 1 + query[1].count("&"))
        assert r.first_segment_length == len(segments[1] if len(segments) > 1 else "")
        for have, want in ((r.digit_ratio, share(u)), (r.host_digit_ratio, share(host)), (r.entropy, entropy(u)), (r.host_entropy, entropy(host))):
            assert math.isclose(have, want, abs_tol=1e-9)


def test_trees_generalise_the_rules(spark):
    rng = random.Random(3)
    urls = []
    for _ in range(1500):
        bad = rng.random() < 0.4
        host = ("".join(rng.choice("0123456789") for _ in range(9)) if bad else rng.choice(["news", "wiki", "blog"])) + rng.choice([".net", ".com"] if rng.random() < 0.7 else [".org"])
        urls.append((f"http://{host}/" + ("a/b/c/d?x=1&y=2" if bad else "p"), bad))
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(urls)], "page_id int, url string")
    rules = {f"{k}{d}.{end}/": "block" for k in () for d in () for end in ()} | {"net/a/": "block", "com/a/": "block", "net/p": "allow", "com/p": "allow"}
    got = {r.page_id: r for r in url_filter.url_verdicts(pages, rules).collect()}
    unseen = [i for i, (u, _) in enumerate(urls) if ".org" in u]
    assert all(got[i].rule is None for i in unseen) and len(unseen) > 100
    assert all((got[i].verdict == "block") == urls[i][1] for i in range(len(urls)))


def test_few_distinct_urls_with_many_rows(spark):
    from pyspark.sql import functions as F

    few = spark.range(120_000).select(F.col("id").alias("page_id"), F.when(F.col("id") % 3 > 0, "http://a2.com/x").otherwise("http://b2.net/es/y").alias("url"))
    got = url_filter.url_verdicts(few).groupBy("verdict").count().collect()
    assert {r.verdict: r["count"] for r in got} == {"allow": 80_000, "block": 40_000}
    base = url_filter.lexical(url_filter.with_rule(url_filter.parsed(few), url_filter.RULES))
    training = url_filter.training_urls(url_filter.with_suffixes(base, url_filter.suffix_statistics(base)))
    assert sorted((r.label, r.weight) for r in training.collect()) == [(0.0, 80_000.0), (1.0, 40_000.0)]


# --- op8 ---------------------------------------------------------------------------------------


def test_texts_of_one_id_link(spark):
    prose = [" ".join(f"{c}{i}" for i in range(60)) for c in "abc"]
    df = spark.createDataFrame([(3, prose[0]), (5, prose[0]), (5, prose[1]), (9, prose[1]), (11, prose[2])], "doc_id bigint, text string")
    assert sorted((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()) == [(3, 3), (5, 3), (5, 3), (9, 3), (11, 11)]
    assert sorted(r.doc_id for r in simhash.drop_near_duplicates(df).collect()) == [3, 11]
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, "").collect()) == [3, 11]
    for a, b in ((0, 1), (1, 0)):  # the text that stays depends on the texts alone
        two = spark.createDataFrame([(3, prose[a]), (3, prose[b])], "doc_id bigint, text string")
        kept = [r.text for r in simhash.drop_near_duplicates(two).collect()]
        assert len(kept) == 1 and kept == [r.text for r in corpus_pipeline.near_duplicates(spark, two, "").collect()]
        first = kept if a == 0 else first  # noqa: F821
        assert kept == first


def test_text_ids(spark):
    line = "one two three four five six seven eight nine ten"
    rows = [("b", line), ("a", line + " x"), ("c", "alone in the dark"), (None, line)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    assert {r.doc_id: r.n_removed for r in line_dedup.line_verdicts(df).collect()} == {None: 0, "a": 1, "b": 1, "c": 0}
    assert {r.doc_id for r in line_dedup.drop_lines(df).collect()} == {None, "c"}
    long = " ".join(f"w{i}" for i in range(400))
    df = spark.createDataFrame([("b", long), ("a", long), ("c", "alone")], "doc_id string, text string")
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(df).collect()} == {"a": "a", "b": "a", "c": "c"}
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, "").collect()} == {"a", "c"}


# --- op9 ---------------------------------------------------------------------------------------


def plain_votes(t):
    w, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
    n, chars = len(w), sum(map(len, w))
    symbols = sum(t.count(c) for c in "#*$%&|<>")
    upper = sum(1 for c in t if c.isupper())
    windows = Counter(tuple(w[i : i + 3]) for i in range(n - 2))
    covered = {i + k for i in range(n - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    ratio = lambda a, b: a / max(b, 1)
    band = lambda v, bad, good: -1 if bad else int(good)
    length, sym, marks, shout = ratio(chars, n), ratio(symbols, n), ratio(symbols, chars), ratio(t.count("!"), n)
    up, rep, dup = ratio(upper, chars), ratio(len(covered), n), ratio(len(lines) - len(set(lines)), len(lines))
    variety, ends = ratio(len(set(w)), n), ratio(t.count(".") + t.count("?"), n)
    votes = (
        band(length, length < 2 or length > 14, 3 <= length <= 11), band(sym, sym > 0.1, sym < 0.02), band(marks, marks > 0.02, marks < 0.005), band(shout, shout > 0.1, shout < 0.02),
        band(up, up > 0.3, up < 0.12), band(rep, rep > 0.35, rep < 0.2), band(dup, dup > 0.5, dup < 0.2), band(variety, variety < (0.3 if n < 1000 else 0.1), variety > 0.4), band(ends, ends < 0.002, ends > 0.02),
    )
    return votes, n < 50 or 100 * len(covered) > 50 * n


def plain_posteriors(patterns):
    """EM over Counter(votes); a function of the votes."""
    k = 9
    prior, good, bad = 0.8, np.full(k, 0.995), np.full(k, 0.3)

    def odds(v):
        return math.log(prior / (1 - prior)) + sum(math.log(good[r] / (1 - bad[r])) if v[r] == 1 else math.log((1 - good[r]) / bad[r]) if v[r] == -1 else 0 for r in range(k))

    for _ in range(quality_rules.EM_ROUNDS):
        g = {v: n / (1 + math.exp(-odds(v))) for v, n in patterns.items()}
        total = sum(patterns.values())
        new_prior = min(max((sum(g.values()) + 1) / (total + 2), 0.02), 0.98)
        rate = lambda weight, vote, start, least: np.array([min(max((20 * start + sum(x for v, x in weight.items() if v[r] == vote)) / (20 + sum(x for v, x in weight.items() if v[r])), least), 0.999) for r in range(k)])
        new_good = rate(g, 1, 0.995, 0.99)
        new_bad = rate({v: n - g[v] for v, n in patterns.items()}, -1, 0.3, 0.05)
        prior, good, bad = new_prior, new_good, new_bad
    return lambda v: 1 / (1 + math.exp(-odds(v)))


def plain_quality(texts):
    judged = {i: plain_votes(t) for i, t in texts.items()}
    posterior = plain_posteriors(Counter(v for v, failed in judged.values() if not failed))
    return {i: (failed, posterior(v)) for i, (v, failed) in judged.items()}


def test_posteriors_equal_plain_python(docs, texts):
    want = plain_quality(texts)
    for r in quality_rules.quality_verdicts(docs).collect():
        failed, posterior = want[r.doc_id]
        assert r.base_failed == failed and math.isclose(r.posterior, posterior, abs_tol=2e-6)
        assert r.kept == (not failed and posterior >= 0.5)


# --- op10 --------------------------------------------------------------------------------------


def test_toxicity_equals_plain_python(docs, labels, texts):
    p = toxicity.Params()
    known = {toxicity.folded(t) for t in toxicity.TERMS}
    terms = [*dict.fromkeys(toxicity.TERMS), *(t for t in toxicity.learned_terms(docs, labels, p) if t not in known)]
    form_of = {}
    for k, term in enumerate(terms):
        for form in (term, term + "s", term + "es"):
            form_of.setdefault(toxicity.folded(form), k)
    excuses = [toxicity.folded(e) for e in toxicity.EXCEPTIONS]
    found = {}
    for i, t in texts.items():
        s = f" {toxicity.folded(t)} "
        spans = [(m.start(), m.start() + len(e) + 2) for e in excuses for m in re.finditer(f"(?= {re.escape(e)} )", s)]
        c = Counter()
        for m in re.finditer(r"(?<= )[^ ]+(?= )", s):
            if m[0] in form_of and not any(a <= m.start() - 1 and m.end() + 1 <= b for a, b in spans):
                c[form_of[m[0]]] += 1
        found[i] = c
    y = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None and r.doc_id in texts and not held_out(r.doc_id, 3, 1)}
    bad, good = sum(y.values()), len(y) - sum(y.values())
    share = bad / (good + bad)
    weights = []
    for k, term in enumerate(terms):
        with_term = [y[i] for i in y if found[i][k]]
        odds = share / (1 - share) * math.exp(p.weak_weight if term in toxicity.WEAK else p.prior_weight)
        weights.append(math.log((sum(with_term) + 4 * odds / (1 + odds)) / (len(with_term) - sum(with_term) + 4 / (1 + odds)) / (share / (1 - share))))
    x = {}
    for i, t in texts.items():
        total = max(0.0, sum(weights[k] * (1 + math.log(n)) for k, n in found[i].items()))
        x[i] = np.array([1.0, math.log1p(total), math.log1p(100 * total / max(len(t.split()), 20))])
    rows = [(np.round(x[i], 3), y[i]) for i in y]
    m, t = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    prior = beta = np.array([-3.0, 2.0, 1.0])
    for _ in range(12):
        q = 1 / (1 + np.exp(-m @ beta))
        step = np.linalg.solve((m.T * (q * (1 - q))) @ m / len(t) + p.ridge * np.eye(3), m.T @ (t - q) / len(t) - p.ridge * (beta - prior))
        beta = beta + step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
        beta[1:] = np.maximum(beta[1:], 0.05)
        if np.abs(step).max() < 1e-4:
            break
    got = {r.doc_id: r for r in toxicity.toxicity_scores(docs, labels).collect()}
    for i, v in x.items():
        assert math.isclose(got[i].score, 1 / (1 + math.exp(-v @ beta)), rel_tol=1e-4, abs_tol=1e-6)
        assert dict(zip(got[i].terms, got[i].counts, strict=True)) == {terms[k]: n for k, n in found[i].items()}
        assert got[i].predicted == int(got[i].score >= 0.7)


# --- pipeline ----------------------------------------------------------------------------------


def grouped(items, linked):
    """The smallest of each group of linked items."""
    items, root = sorted(items), {i: i for i in items}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, i in enumerate(items):
        for j in items[:n]:
            if linked(i, j):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return {i for i in items if top(i) == i}


def test_pipeline_equals_plain_python(spark, docs, texts, tmp_path):
    quality = plain_quality(texts)
    left = {i: t for i, t in texts.items() if not quality[i][0] and quality[i][1] >= 0.5}
    seen, cut = [], {}
    by_word = defaultdict(list)
    for i in sorted(left):
        kept, lost = [], False
        for line in left[i].split("\n"):
            w = frozenset(WORD.findall(line.translate(TO_LOWER)))
            similar = any(5 * len(w & seen[k]) >= 4 * len(w | seen[k]) for k in {k for x in w for k in by_word[x]})
            if w and similar:
                lost = True
            else:
                kept.append(line)
            if w:
                for x in w:
                    by_word[x].append(len(seen))
                seen.append(w)
        if not lost or WORD.search("\n".join(kept)):
            cut[i] = "\n".join(kept) if lost else left[i]
    sets = {}
    for i, t in cut.items():
        w = WORD.findall(t.translate(TO_LOWER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    stay = grouped(cut, lambda i, j: 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]))
    strip = '!"#$%&\'()*+,-./:;<=>?@[\\]^_`{|}~'
    tokens = lambda t: [x for x in (y.strip(strip) for y in t.lower().split()) if x]
    items = [w for r in table(spark, DATA, "benchmark").collect() if len(w := tokens(r.text)) >= 13]
    grams = defaultdict(list)
    for n, b in enumerate(items):
        for q in range(len(b) - 3):
            grams[tuple(b[q : q + 4])].append((n, q))

    def leaky(t):
        w = tokens(t)
        for p in range(len(w) - 3):
            for n, q in grams.get(tuple(w[p : p + 4]), ()):
                b = items[n]
                for s in range(max(-p, -q, -12), 4):
                    x, y = w[p + s : p + s + 13], b[q + s : q + s + 13]
                    if len(x) == len(y) == 13 and sum(u == v for u, v in zip(x, y, strict=True)) >= 11:
                        return True
        return False

    clean = {i: cut[i] for i in stay if not leaky(cut[i])}
    folder, have = str(tmp_path), docs
    for (name, stage), want in zip(corpus_pipeline.STAGES, (left, cut, {i: cut[i] for i in stay}, clean), strict=False):
        stage(spark, have, DATA).write.parquet(f"{folder}/{name}")
        have = spark.read.parquet(f"{folder}/{name}")
        assert {r.doc_id: r.text for r in have.collect()} == want, name
    copies = {r.doc_id: r.copies for r in mixing.mix_documents(have).collect() if r.copies}
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, DATA).collect()) == copies
