"""What the first review found missing."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from siftspark.llm import document_dedup, katz, pii, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k=5):
    w = WORD.findall(text.lower())
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1)))


def test_near_duplicate_stage_equals_brute_force(spark):
    rng = random.Random(5)
    originals = [[f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 60, 150, 400]))] for _ in range(40)]
    texts = [list(x) for x in originals]
    for _ in range(160):  # copies on both sides of the threshold
        x = list(rng.choice(originals))
        for _ in range(rng.randint(0, max(1, len(x) // 25))):
            x[rng.randrange(len(x))] = f"n{rng.randrange(9)}"
        texts.append(x)
    rng.shuffle(texts)
    texts = [" ".join(x) for x in texts]
    sets = [shingles(t) for t in texts]
    near = [(i, j) for j in range(len(texts)) for i in range(j) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    assert sum(0.8 <= len(sets[i] & sets[j]) / len(sets[i] | sets[j]) < 0.95 for i, j in near) > 20
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in near:
        a, b = sorted((top(i), top(j)))
        root[b] = a
    want = {i for i in range(len(texts)) if top(i) == i}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, df, "").collect()} == want
    few = document_dedup.line_dedup.Params(shingle=5, block=2, few=2, bucket=50, piece=5000)
    assert {r.doc_id for r in document_dedup.drop_near_documents(df, few).collect()} == want


def test_url_suffixes_are_counted_apart(spark):
    hosts = [f"d{i % 3000}.{'org' if i % 3 else 'com'}" for i in range(7000)] + ["localhost", ""]
    pages = spark.createDataFrame([(i, f"http://{h}/x") for i, h in enumerate(hosts)], "page_id int, url string")
    base = url_filter.lexical(url_filter.with_rule(url_filter.parsed(pages), {f"d{k}.com/": "block" for k in range(0, 30, 3)} | {"d300.com/": "allow"}))
    rows = {r.page_id: r for r in url_filter.with_suffixes(base, url_filter.suffix_statistics(base)).collect()}
    ends = [(h.split(".")[-1], ".".join(h.split(".")[-2:])) for h in hosts]
    fold = {r.page_id: r.f for r in base.select("page_id", url_filter._fold(url_filter.Params()).alias("f")).collect()}
    known, bad = Counter(), Counter()
    for i, ends_ in enumerate(ends):
        for key in enumerate(ends_, 1):
            for k in range(6):
                outside = rows[i].label is not None and fold[i] != k
                known[key, k] += outside
                bad[key, k] += rows[i].label if outside else 0
    count = Counter(one for one, _ in ends)
    assert len(rows) == len(hosts) and len(set(fold.values())) >= 4
    for i, (one, two) in enumerate(ends):
        assert math.isclose(rows[i].suffix_count, math.log1p(count[one]))
        for key, have in (((1, one), rows[i].suffix_blocked), ((2, two), rows[i].second_suffix_blocked)):
            assert math.isclose(have, (bad[key, fold[i]] + 5) / (known[key, fold[i]] + 10))


@pytest.mark.parametrize(
    ("text", "kind", "value"),
    [
        ("pay 4111 1111 1111 1111 12/25", "card", "4111 1111 1111 1111"),
        ("no 7 4111 1111 1111 1111", "card", "4111 1111 1111 1111"),
        ("no 7-4111-1111-1111-1111 x", "card", "4111-1111-1111-1111"),
        ("12 3782 822463 10005 ok", "card", "3782 822463 10005"),
        ("+123 4111 1111 1111 1111", "card", "4111 1111 1111 1111"),
        ("AT61 1904 3002 3457 3201 EUR", "iban", "AT61 1904 3002 3457 3201"),
        ("AB12 DE89 3704 0044 0532 0130 00", "iban", "DE89 3704 0044 0532 0130 00"),
    ],
)
def test_values_beside_others_are_found(text, kind, value):
    new, found = pii.pseudonymised(text, b"key")
    assert found == {kind: 1} and new == text.replace(value, pii.pseudonym(kind, value, b"key")) != text


@pytest.mark.parametrize("params", [katz.Params(), katz.Params(dense=2, piece=40_000, bucket=30_000)], ids=["as set", "small pieces"])
def test_katz_equals_brute_force_over_words(spark, params):
    rng = random.Random(8)
    texts = [" ".join(f"w{int(rng.paretovariate(0.5)) % 100_000}" for _ in range(rng.randint(0, 900))) for _ in range(500)]
    got = katz.language_scores(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), params).collect()
    tokens = [[*WORD.findall(t), "</s>"] for t in texts]
    held = [zlib.crc32(str(i).encode()) % 5 == 1 for i in range(len(texts))]
    words_, pairs = Counter(), defaultdict(Counter)
    for w, out in zip(tokens, held, strict=True):
        if not out:
            words_.update(w)
            for a, b in zip(["<s>", *w], w, strict=False):
                pairs[a][b] += 1
    assert sum(words_.values()) > 2**17  # words seen once shared classes before
    weight = sum(words_.values()) + 0.5 * (len(words_) + 1)
    p = lambda w: (words_[w] + 0.5) / weight
    discount = katz.good_turing(np.bincount([min(c, 7) for after in pairs.values() for c in after.values()], minlength=8), 5)
    less = lambda c: c * discount[c] if c < len(discount) else c
    total = {a: sum(after.values()) for a, after in pairs.items()}
    kept = {a: sum(map(less, after.values())) / total[a] for a, after in pairs.items()}
    free = {a: 1 - sum(map(p, after)) for a, after in pairs.items()}

    def log_p(a, b):
        if a not in pairs:
            return math.log10(p(b))
        scale = total[a] / (total[a] + 1) if kept[a] > 1 - 1e-9 else 1.0
        return math.log10(scale * less(pairs[a][b]) / total[a] if pairs[a][b] else (1 - scale * kept[a]) / free[a] * p(b))

    assert len(got) == len(texts)
    for r in got:
        w = tokens[r.doc_id]
        assert math.isclose(r.score, sum(log_p(a, b) for a, b in zip(["<s>", *w], w, strict=False)), rel_tol=1e-6, abs_tol=1e-5)
