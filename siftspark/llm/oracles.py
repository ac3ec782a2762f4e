"""The same results in DuckDB's SQL, by plainer ways, where SQL can express them."""

from __future__ import annotations

import string

from siftspark.llm import decontaminate, filter_audit, katz, line_dedup, merkle, quality_rules, simhash
from siftspark.llm.mixing import PRODUCTION, Mix

SPACES = "[ \\t\\n\\x0B\\f\\r]+"
UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def mixing_sql(mix: Mix = PRODUCTION) -> str:
    """Raking by recursion over the three lists of factors."""
    (_, sk, ts), (_, lk, tl), (_, tk, tt) = mix.axes()
    a, b, c = len(sk), len(lk), len(tk)
    place = lambda column, keys: f"COALESCE(list_position([{', '.join(map(_text, keys[:-1]))}], {column}), {len(keys)}) - 1"
    numbers = lambda v: "[" + ", ".join(f"{x!r}::DOUBLE" for x in v) + "]"
    total = lambda n, term: f"list_sum(list_transform(range({n}), lambda j: {term}))"
    mass = (
        total(b * c, f"seed[(x * {b * c} + j + 1)::BIGINT]"),
        total(a * c, f"seed[((j // {c}) * {b * c} + x * {c} + j % {c} + 1)::BIGINT]"),
        total(a * b, f"seed[((j // {b}) * {b * c} + (j % {b}) * {c} + x + 1)::BIGINT]"),
    )
    fitted = (
        total(b * c, f"seed[(x * {b * c} + j + 1)::BIGINT] * f.l[(j // {c} + 1)::BIGINT] * f.t[(j % {c} + 1)::BIGINT]"),
        total(a * c, f"seed[((j // {c}) * {b * c} + x * {c} + j % {c} + 1)::BIGINT] * f.s[(j // {c} + 1)::BIGINT] * f.t[(j % {c} + 1)::BIGINT]"),
        total(a * b, f"seed[((j // {b}) * {b * c} + (j % {b}) * {c} + x + 1)::BIGINT] * f.s[(j // {b} + 1)::BIGINT] * f.l[(j % {b} + 1)::BIGINT]"),
    )
    share = lambda v, n, m: f"list_transform(range({n}), lambda x: CASE WHEN {m} > 0 THEN {numbers(v)}[(x + 1)::BIGINT] ELSE 0.0::DOUBLE END)"
    scaled = lambda v: f"list_transform({v}, lambda y: COALESCE(y / NULLIF(list_sum({v}), 0), 0.0::DOUBLE))"
    step = lambda v, n, m: f"list_transform(range({n}), lambda x: COALESCE({v}[(x + 1)::BIGINT] / NULLIF({m}, 0), 0.0::DOUBLE))"
    ones = lambda n: numbers([1.0] * n)
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, lang, COALESCE(text, '') AS x FROM documents
), tr AS (
  SELECT doc_id, source, lang, len(regexp_extract_all(x, '[^ \\t\\n\\x0B\\f\\r]+')) AS n_tokens,
    CASE WHEN contains(x, ' | ') THEN 'table' WHEN regexp_matches(lower(x), 'licen[sc]e|copyright') THEN 'notice'
      WHEN regexp_matches(x, '@[A-Za-z0-9.-]+\\.[a-z]|\\([0-9]{{3}}\\) [0-9]{{3}}-[0-9]{{4}}') THEN 'contact' WHEN length(x) < 500 THEN 'brief' ELSE '*' END AS topic FROM d
), ce AS (
  SELECT *, ({place('source', sk)}) * {b * c} + ({place('lang', lk)}) * {c} + ({place('topic', tk)}) AS cell FROM tr
), n AS (
  SELECT cell, SUM(n_tokens)::DOUBLE AS n FROM ce GROUP BY 1
), sd AS (
  SELECT list(COALESCE(n, 0.0) ORDER BY r.i) AS seed FROM range({a * b * c}) r(i) LEFT JOIN n ON n.cell = r.i
), tg AS (
  SELECT seed, list_sum(seed) AS total, {share(ts, a, mass[0])} AS s0, {share(tl, b, mass[1])} AS l0, {share(tt, c, mass[2])} AS t0 FROM sd
), tn AS (
  SELECT seed, total, {scaled('s0')} AS ts, {scaled('l0')} AS tl, {scaled('t0')} AS tt FROM tg
), f AS (
  SELECT 0 AS i, {ones(a)} AS s, {ones(b)} AS l, {ones(c)} AS t
  UNION ALL
  SELECT i + 1, CASE WHEN i % 3 = 0 THEN {step('ts', a, fitted[0])} ELSE s END, CASE WHEN i % 3 = 1 THEN {step('tl', b, fitted[1])} ELSE l END, CASE WHEN i % 3 = 2 THEN {step('tt', c, fitted[2])} ELSE t END
  FROM f, tn WHERE i < {3 * mix.rounds}
), w AS (
  SELECT r.i AS cell, seed[r.i + 1] AS n, total, seed[r.i + 1] * s[r.i // {b * c} + 1] * l[r.i // {c} % {b} + 1] * t[r.i % {c} + 1] AS weight
  FROM f, tn, range({a * b * c}) r(i) WHERE f.i = {3 * mix.rounds}
), q AS (
  SELECT ce.*, weight, COALESCE({mix.budget!r} * total * weight / NULLIF(n, 0), 0.0) AS rate,
    ('0x' || substr(md5('{mix.seed}:' || COALESCE(doc_id::VARCHAR, '')), 1, 13))::BIGINT / {float(2**52)!r}::DOUBLE AS draw FROM ce JOIN w USING (cell)
)
SELECT doc_id, source, lang, topic, n_tokens::BIGINT AS n_tokens, ROUND(weight, 6) AS cell_share, ROUND(rate, 6) AS rate,
  (FLOOR(rate) + CASE WHEN draw < rate - FLOOR(rate) THEN 1 ELSE 0 END)::INTEGER AS copies FROM q"""


def leaks_sql(params: decontaminate.Params = decontaminate.Params()) -> str:
    """A window of 13 with at most two differences has four tokens in a row that agree: join on those and compare."""
    w, least = params.window, params.least_equal
    tokens = lambda column: f"list_filter(list_transform(regexp_split_to_array(lower(COALESCE({column}, '')), '{SPACES}'), lambda y: trim(y, {_text(string.punctuation)})), lambda y: y <> '')"
    return f"""
WITH d AS (SELECT doc_id, {tokens('text')} AS tok FROM documents),
b0 AS (SELECT item_id, {tokens('text')} AS tok FROM benchmark),
b AS (SELECT MIN(item_id) AS item_id, tok FROM b0 WHERE len(tok) >= {w} GROUP BY tok),
dg AS (SELECT doc_id, i, tok[i:i+3] AS g FROM (SELECT doc_id, tok, unnest(range(1, len(tok) - 2)) AS i FROM d)),
bg AS (SELECT item_id, i, tok[i:i+3] AS g FROM (SELECT item_id, tok, unnest(range(1, len(tok) - 2)) AS i FROM b)),
al AS (SELECT DISTINCT doc_id, item_id, dg.i - bg.i AS shift FROM dg JOIN bg USING (g)),
wn AS (SELECT al.*, d.tok AS dt, b.tok AS bt, unnest(range(1, len(b.tok) - {w} + 2)) AS s FROM al JOIN d USING (doc_id) JOIN b USING (item_id)),
hit AS (SELECT doc_id, item_id, shift + s - 1 AS a, shift + s - 1 + {w} AS z FROM wn
  WHERE shift + s >= 1 AND shift + s + {w - 1} <= len(dt) AND len(list_filter(range({w}), lambda k: dt[(shift + s + k)::BIGINT] = bt[(s + k)::BIGINT])) >= {least}),
h1 AS (SELECT DISTINCT * FROM hit),
isl AS (SELECT *, SUM(fresh) OVER (PARTITION BY doc_id, item_id ORDER BY a, z ROWS UNBOUNDED PRECEDING) AS k FROM (
  SELECT *, CASE WHEN a <= MAX(z) OVER (PARTITION BY doc_id, item_id ORDER BY a, z ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM h1)),
sp AS (SELECT doc_id, item_id, MIN(a) AS a, MAX(z) AS z FROM isl GROUP BY doc_id, item_id, k),
f AS (SELECT doc_id, COUNT(DISTINCT item_id) AS n, array_to_string(list_sort(list_distinct(list(item_id)))::VARCHAR[], ',') AS items,
  string_agg(item_id || ':' || a || '-' || z, ',' ORDER BY item_id, a, z) AS spans FROM sp GROUP BY 1)
SELECT doc_id, len(tok)::BIGINT AS n_tokens, n IS NOT NULL AS contaminated, COALESCE(n, 0)::INTEGER AS n_items, COALESCE(items, '') AS items, COALESCE(spans, '') AS spans FROM d LEFT JOIN f USING (doc_id)"""


def lines_sql(params: line_dedup.Params = line_dedup.Params()) -> str:
    """Words by document frequency, a join on the first few of each set, and whole sets compared."""
    num, den = params.num, params.den
    return f"""
WITH d AS (SELECT doc_id, string_split(COALESCE(text, ''), chr(10)) AS ls FROM documents),
x AS (SELECT doc_id, i - 1 AS number, list_sort(list_distinct(list_filter(regexp_split_to_array(translate(ls[i], '{UPPER}', '{LOWER}'), '{SPACES}'), lambda y: y <> ''))) AS ws
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
l AS (SELECT doc_id, number, ws, ROW_NUMBER() OVER (ORDER BY doc_id, number) AS r FROM x WHERE len(ws) > 0),
s AS (SELECT ws, MIN(r) AS r, len(ws) AS n FROM l GROUP BY ws),
tk AS (SELECT r, n, unnest(ws) AS w FROM s),
df AS (SELECT w, COUNT(*) AS df FROM tk GROUP BY 1),
pf AS (SELECT r, n, w FROM (SELECT r, n, w, ROW_NUMBER() OVER (PARTITION BY r ORDER BY df, w) AS i FROM tk JOIN df USING (w)) WHERE i <= n - CEIL(n * {num} / {den}::DOUBLE - 1e-9) + 1),
cd AS (SELECT DISTINCT a.r AS a, b.r AS b FROM pf a JOIN pf b ON a.w = b.w AND a.r < b.r AND {den} * LEAST(a.n, b.n) >= {num} * GREATEST(a.n, b.n)),
sm AS (SELECT DISTINCT cd.b AS r FROM cd JOIN s x ON x.r = cd.a JOIN s y ON y.r = cd.b WHERE {den} * len(list_intersect(x.ws, y.ws)) >= {num} * (x.n + y.n - len(list_intersect(x.ws, y.ws)))),
g AS (SELECT l.doc_id, l.number FROM l JOIN s USING (ws) WHERE l.r > s.r OR s.r IN (SELECT r FROM sm)),
a AS (SELECT doc_id, COUNT(*) AS n, string_agg(number::VARCHAR, ',' ORDER BY number) AS removed FROM g GROUP BY 1)
SELECT doc_id, len(ls)::INTEGER AS n_lines, COALESCE(n, 0)::INTEGER AS n_removed, COALESCE(removed, '') AS removed FROM d LEFT JOIN a USING (doc_id)"""


def _crc32(value: str) -> str:
    """CRC-32 of a text of ASCII characters, bit by bit."""
    step = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, k: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))"
    letters = f"list_transform(string_split({value}, ''), lambda s: ascii(s)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {letters}), lambda c, b: {step}), 4294967295)"


def katz_sql(params: katz.Params = katz.Params()) -> str:
    """Tokens one by one, joined with the counts of words, pairs and contexts. Start and end have a blank, so no word is like them."""
    most = params.most_discounted
    counts = ", ".join(f"COALESCE(MAX(n) FILTER (c = {k}), 0)::DOUBLE AS n{k}" for k in range(1, most + 2))
    common = f"(CASE WHEN n1 > 0 THEN {most + 1} * n{most + 1} / n1 ELSE 1 END)"
    absolute = "LEAST(CASE WHEN n1 > 0 AND n2 > 0 THEN n1 / (n1 + 2 * n2) ELSE 0.5 END, 0.9)"
    discounts = " UNION ALL ".join(
        f"SELECT {c} AS c, CASE WHEN d > 0 AND d < 1 THEN d ELSE ({c} - {absolute}) / {c} END AS disc FROM (SELECT *, CASE WHEN n{c} > 0 AND {common} < 1 THEN ({c + 1} * n{c + 1} / ({c} * n{c}) - {common}) / (1 - {common}) ELSE -1 END AS d FROM gt)"
        for c in range(1, most + 1)
    )
    return f"""
WITH tk AS (SELECT doc_id, COALESCE({_crc32("doc_id::VARCHAR")} % {params.folds} = {params.held_out_fold}, FALSE) AS held,
  list_append(list_filter(regexp_split_to_array(translate(COALESCE(text, ''), '{UPPER}', '{LOWER}'), '{SPACES}'), lambda y: y <> ''), ' end') AS ws FROM documents),
tok AS (SELECT doc_id, held, unnest(ws) AS w, unnest(list_prepend(' start', ws[1:len(ws) - 1])) AS b FROM tk),
un AS (SELECT w, COUNT(*) AS c FROM tok WHERE NOT held GROUP BY 1),
nv AS (SELECT COALESCE(SUM(c), 0)::BIGINT AS n, COALESCE(SUM(c), 0)::DOUBLE + 0.5 * (COUNT(*) + 1) AS wt FROM un),
pr AS (SELECT b, w, COUNT(*) AS c FROM tok WHERE NOT held GROUP BY 1, 2),
gt AS (SELECT {counts} FROM (SELECT c, COUNT(*) AS n FROM pr GROUP BY 1)),
ds AS ({discounts}),
pd AS (SELECT b, w, pr.c, pr.c * COALESCE(disc, 1) AS dc FROM pr LEFT JOIN ds USING (c)),
c0 AS (SELECT b, SUM(pd.c)::DOUBLE AS total, SUM(dc) / SUM(pd.c) AS share, 1 - SUM((un.c + 0.5) / wt) AS unseen FROM pd JOIN un USING (w), nv GROUP BY 1),
c1 AS (SELECT *, CASE WHEN unseen < 1e-9 AND share > 0 THEN 1 / share WHEN share > 1 - 1e-9 THEN total / (total + 1) ELSE 1 END AS scale FROM c0),
cx AS (SELECT *, CASE WHEN unseen < 1e-9 THEN 0 ELSE (1 - share * scale) / unseen END AS backoff FROM c1)
SELECT doc_id, held AS held_out, COUNT(*) AS n_tokens, COUNT(un.c) AS n_known, ANY_VALUE(n) AS train_tokens, ROUND(SUM(LOG10((COALESCE(un.c, 0) + 0.5) / wt)), 6) AS base_score,
  SUM(ROUND(LOG10(CASE WHEN pd.c IS NOT NULL THEN scale * dc / total ELSE COALESCE(backoff, 1) * (COALESCE(un.c, 0) + 0.5) / wt END), 6)::DECIMAL(18,6))::DOUBLE AS score
FROM tok LEFT JOIN un USING (w) LEFT JOIN pd USING (b, w) LEFT JOIN cx USING (b), nv GROUP BY doc_id, held"""


def quality_sql() -> str:
    """Statistics by lists and a count of windows; expectation-maximisation by recursion over the list of vote patterns."""
    q = quality_rules
    band = lambda value, bad, good: f"CASE WHEN {bad.format(value)} THEN -1 WHEN {good.format(value)} THEN 1 ELSE 0 END"
    share = lambda a, b: f"({a} / GREATEST({b}, 1)::DOUBLE)"
    votes = (
        band(share("word_chars", "n_words"), "({0} < 2 OR {0} > 14)", "({0} >= 3 AND {0} <= 11)"),
        band(share("n_symbols", "n_words"), "{0} > 0.1", "{0} < 0.02"),
        band(share("n_symbols", "word_chars"), "{0} > 0.02", "{0} < 0.005"),
        band(share("n_shouts", "n_words"), "{0} > 0.1", "{0} < 0.02"),
        band(share("n_upper", "word_chars"), "{0} > 0.3", "{0} < 0.12"),
        band(share("n_repeat_words", "n_words"), "{0} > 0.35", "{0} < 0.2"),
        band(share("n_dup_lines", "n_lines"), "{0} > 0.5", "{0} < 0.2"),
        band(share("n_distinct", "n_words"), "{0} < CASE WHEN n_words < 1000 THEN 0.3 ELSE 0.1 END", "{0} > 0.4"),
        band(share("n_sentences", "n_words"), "{0} < 0.002", "{0} > 0.02"),
    )
    n = len(votes)
    odds = lambda v: f"(LN(prior / (1 - prior)) + list_sum(list_transform(range(1, {n + 1}), lambda r: CASE {v}[r] WHEN 1 THEN LN(good[r] / (1 - bad[r])) WHEN -1 THEN LN((1 - good[r]) / bad[r]) ELSE 0 END)))"
    total = lambda weight, test: f"list_sum(list_transform(range(1, len(p) + 1), lambda k: CASE WHEN {test} THEN {weight} ELSE 0 END))"
    rate = lambda weight, vote, start, least: f"list_transform(range(1, {n + 1}), lambda r: LEAST(GREATEST(({q.PRIOR_VOTES} * {start} + {total(weight, f'p[k].v[r] = {vote}')}) / ({q.PRIOR_VOTES} + {total(weight, 'p[k].v[r] <> 0')}), {least}), 0.999))"
    ones = lambda x: "[" + ", ".join([f"{x}::DOUBLE"] * n) + "]"
    blank = "[ \\t\\n\\x0B\\f\\r]"
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, COALESCE(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '{SPACES}'), lambda y: y <> '') AS ws, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^ \\t\\n\\x0B\\f\\r]')) AS ls FROM d),
win AS (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, g) AS c FROM (SELECT doc_id, i, ws[i:i+2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w))),
rep AS (SELECT doc_id, COUNT(DISTINCT i + k) AS n FROM win, range(3) r(k) WHERE c > 1 GROUP BY 1),
st AS (SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '{blank}', '', 'g')) AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines, len(ls) AS n_lines,
  len(list_distinct(ws)) AS n_distinct, len(regexp_extract_all(t, '\\p{{Lu}}')) AS n_upper, len(regexp_extract_all(t, '!')) AS n_shouts, len(regexp_extract_all(t, '[.?]')) AS n_sentences, COALESCE(rep.n, 0) AS n_repeat_words FROM w LEFT JOIN rep USING (doc_id)),
v AS (SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS failed, [{", ".join(votes)}] AS votes FROM st),
pt AS (SELECT COALESCE(list({{'v': votes, 'n': n::DOUBLE}} ORDER BY votes), []) AS p, COALESCE(SUM(n), 0)::DOUBLE AS total FROM (SELECT votes, COUNT(*) AS n FROM v WHERE NOT failed GROUP BY 1)),
em AS (SELECT 0 AS i, {q.PRIOR_GOOD}::DOUBLE AS prior, {ones(q.GOOD_ACCURACY)} AS good, {ones(q.BAD_ACCURACY)} AS bad
  UNION ALL SELECT i + 1, LEAST(GREATEST((COALESCE(list_sum(g), 0) + 1) / (total + 2), 0.02), 0.98), {rate("g[k]", 1, q.GOOD_ACCURACY, q.GOOD_LEAST)}, {rate("(p[k].n - g[k])", -1, q.BAD_ACCURACY, q.BAD_LEAST)}
  FROM (SELECT i, p, total, list_transform(p, lambda x: x.n / (1 + EXP(-{odds("x.v")}))) AS g FROM em, pt WHERE i < {q.EM_ROUNDS})),
sc AS (SELECT v.*, 1 / (1 + EXP(-{odds("votes")})) AS posterior FROM v, em WHERE em.i = {q.EM_ROUNDS})
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, failed AS base_failed, NOT failed AND posterior >= 0.5 AS kept, ROUND(posterior, 6) AS posterior FROM sc"""


def _hash_steps(seed: int) -> list[str]:
    """The steps of XXH64 as SELECTs, each over the one before (s, hx: the bytes in hexadecimal, n: their number, and h so far)."""
    p1, p2, p3, p4, p5 = (f"{int(p)}::UHUGEINT" for p in simhash.PRIMES)
    whole = f"{2**64}::UHUGEINT"
    turned = lambda x, k: f"((({x}) * {2**k}::UHUGEINT) % {whole} + ({x}) // {2 ** (64 - k)}::UHUGEINT)"
    times = lambda x, p: f"((({x}) * {p}) % {whole})"
    either = lambda x, y: f"xor(({x})::UBIGINT, ({y})::UBIGINT)::UHUGEINT"
    number = lambda at, k: "('0x' || " + " || ".join(f"substr(hx, (2 * ({at} + {i}) + 1)::BIGINT, 2)" for i in reversed(range(k))) + ")::UBIGINT::UHUGEINT"
    lane = lambda acc, x: times(turned(f"(({acc}) + {times(x, p2)}) % {whole}", 31), p1)
    starts = (seed + int(simhash.PRIMES[0]) + int(simhash.PRIMES[1])) % 2**64, (seed + int(simhash.PRIMES[1])) % 2**64, seed, (seed - int(simhash.PRIMES[0])) % 2**64
    stripes = [f"list_reduce(list_prepend({v}::UHUGEINT, list_transform(range(n // 32), lambda k: {number(f'(32 * k + {8 * i})', 8)})), lambda acc, x: {lane('acc', 'x')})" for i, v in enumerate(starts)]
    steps = [
        "SELECT s, hex(s) AS hx, strlen(s) AS n FROM (SELECT DISTINCT s FROM sh)",
        "SELECT *, " + ", ".join(f"CASE WHEN n >= 32 THEN {v} END AS v{i}" for i, v in enumerate(stripes)) + " FROM {0}",
        f"SELECT *, CASE WHEN n >= 32 THEN ({turned('v0', 1)} + {turned('v1', 7)} + {turned('v2', 12)} + {turned('v3', 18)}) % {whole} ELSE {(seed + int(simhash.PRIMES[4])) % 2**64}::UHUGEINT END AS h FROM {{0}}",
    ]
    keep = "SELECT * REPLACE (CASE WHEN {test} THEN {value} ELSE h END AS h) FROM {{0}}"
    step = lambda test, value: steps.append(keep.format(test=test, value=value))
    for i in range(4):
        step("n >= 32", f"({times(either('h', lane('0::UHUGEINT', f'v{i}')), p1)} + {p4}) % {whole}")
    step("TRUE", f"(h + n::UHUGEINT) % {whole}")
    for k in range(3):
        step(f"n % 32 >= {8 * k + 8}", f"({times(turned(either('h', lane('0::UHUGEINT', number(f'(n // 32 * 32 + {8 * k})', 8))), 27), p1)} + {p4}) % {whole}")
    step("n % 8 >= 4", f"({times(turned(either('h', times(number('(n // 8 * 8)', 4), p1)), 23), p2)} + {p3}) % {whole}")
    for k in range(3):
        step(f"n % 4 > {k}", times(turned(either("h", times(number(f"(n // 4 * 4 + {k})", 1), p5)), 11), p1))
    for k, p in ((33, p2), (29, p3)):
        step("TRUE", times(either("h", f"h // {2**k}::UHUGEINT"), p))
    step("TRUE", either("h", f"h // {2**32}::UHUGEINT"))
    return steps


def simhash_sql(params: simhash.Params = simhash.Params()) -> str:
    """XXH64 in whole numbers of 128 bits, bits counted one by one, all pairs of fingerprints, and what each reaches."""
    steps = _hash_steps(simhash.SEED)
    hashes = ",\n".join(f"x{i} AS MATERIALIZED ({q.replace('{0}', f'x{i - 1}')})" for i, q in enumerate(steps))
    k = params.shingle
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(COALESCE(text, ''), '{UPPER}', '{LOWER}'), '{SPACES}'), lambda y: y <> '') AS ws FROM documents),
sh AS (SELECT doc_id, s, COUNT(*) AS c FROM (SELECT doc_id, array_to_string(ws[i:i + {k - 1}], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, GREATEST(len(ws) - {k - 2}, 2))) AS i FROM d WHERE len(ws) > 0)) GROUP BY 1, 2),
{hashes},
bt AS (SELECT doc_id, b, SUM(c * ((h::UBIGINT >> b) & 1)::BIGINT) AS ones, SUM(c) AS n FROM sh JOIN x{len(steps) - 1} USING (s), range(64) r(b) GROUP BY 1, 2),
fp AS (SELECT doc_id, COALESCE(SUM(CASE WHEN 2 * ones > n THEN 1::HUGEINT << b::HUGEINT ELSE 0::HUGEINT END), 0)::UBIGINT AS f FROM d LEFT JOIN bt USING (doc_id) GROUP BY 1),
un AS (SELECT f, MIN(doc_id) AS least FROM fp GROUP BY 1),
l AS (SELECT x.f AS a, y.f AS b FROM un x JOIN un y ON x.f <> y.f AND bit_count(xor(x.f, y.f)::BIT) <= {params.radius}),
r AS (SELECT f AS a, f AS b FROM un UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
co AS (SELECT r.a AS f, MIN(least) AS component_id FROM r JOIN un ON un.f = r.b GROUP BY 1)
SELECT doc_id, lpad(lower(hex(f)), 16, '0') AS fingerprint, component_id FROM fp JOIN co USING (f)"""


def merkle_sql(fanout: int = merkle.Params().fanout, levels: int = 6, levels_above: int = 4) -> str:
    """Trees level by level, over numbered rows and then over the groups' roots; levels suffice for 16 million rows of a source, 65,536 sources."""
    digits = merkle.DIGITS
    written = lambda c: f"COALESCE(strlen({c}) || ':' || {c}, '-')"
    row = lambda text: "sha256(" + " || ".join(written(text if c == "text" else f"{c}::VARCHAR") for c in merkle.COLUMNS) + ")"
    up = lambda name, k: f"""{name}{k + 1} AS MATERIALIZED (SELECT g, p AS i, c, n AS below, (n + {fanout - 1}) // {fanout} AS n, CASE WHEN n = 1 THEN c ELSE sha256(c) END AS h
  FROM (SELECT g, n, i // {fanout} AS p, string_agg(h, '' ORDER BY i) AS c FROM {name}{k} GROUP BY ALL))"""  # noqa: E731
    before, after = f"substr(c, 1, ({digits} * (r.i % {fanout}))::BIGINT)", f"substr(c, ({digits} * (r.i % {fanout}) + {digits + 1})::BIGINT)"
    climbed = lambda rows, name, k: f"""{rows}{k + 1} AS (SELECT r.* REPLACE (r.i // {fanout} AS i, CASE WHEN below = 1 THEN x ELSE sha256({before} || x || {after}) END AS x, CASE WHEN below = 1 THEN proof ELSE proof || {before} || {after} END AS proof)
  FROM {rows}{k} r JOIN {name}{k + 1} t ON r.g IS NOT DISTINCT FROM t.g AND t.i = r.i // {fanout})"""  # noqa: E731
    return f"""
WITH d AS (SELECT doc_id, source, {row("text")} AS leaf, CASE WHEN {_crc32("doc_id::VARCHAR")} % 5 = 0 THEN {row(f"translate(text, '{UPPER}', '{LOWER}')")} END AS bad FROM documents),
l AS MATERIALIZED (SELECT *, ROW_NUMBER() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, COUNT(*) OVER (PARTITION BY source) AS n FROM d),
t0 AS (SELECT source AS g, i, n, leaf AS h FROM l),
{", ".join(up("t", k) for k in range(levels))},
s AS (SELECT g AS source, h AS subroot, ROW_NUMBER() OVER (ORDER BY g NULLS FIRST) - 1 AS i, COUNT(*) OVER () AS n FROM t{levels}),
u0 AS (SELECT 0 AS g, i, n, subroot AS h FROM s),
{", ".join(up("u", k) for k in range(levels_above))},
r0 AS (SELECT doc_id, leaf, source AS g, i, COALESCE(bad, leaf) AS x, '' AS proof FROM l),
{", ".join(climbed("r", "t", k) for k in range(levels))},
q0 AS (SELECT doc_id, leaf, subroot, 0 AS g, s.i, x, proof FROM r{levels} r JOIN s ON r.g IS NOT DISTINCT FROM s.source),
{", ".join(climbed("q", "u", k) for k in range(levels_above))}
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, x AS folded_root, x = h AS verified FROM q{levels_above}, u{levels_above}"""


def audit_sql(params: filter_audit.Params = filter_audit.Params()) -> str:
    """Documents counted by what they fail, and every order of the filters applied to them step by step."""
    p, k = params, len(filter_audit.FILTERS)
    marks = "".join(f"\\{c}" for c in p.marks)
    orders = " || ".join(f"c{i}.c" for i in range(k))
    letters = ", ".join(f"letters c{i}" for i in range(k))
    other = " AND ".join(f"c{i}.c <> c{j}.c" for i in range(k) for j in range(i))
    passed = lambda upto: f"len(list_filter(range(1, {upto} + 1), lambda j: fails[ascii(filter_order[j]) - 64])) = 0"
    count = lambda column, test: f"COALESCE(SUM({column}) FILTER ({test}), 0)::BIGINT"
    here = "fails[ascii(filter_order[step]) - 64]"
    return f"""
WITH d AS (SELECT doc_id, COALESCE(source, '') AS part, COALESCE(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(t, '{SPACES}'), lambda y: y <> '') AS ws, MIN(doc_id) OVER (PARTITION BY t) AS least FROM d),
f AS (SELECT doc_id, part, [len(ws) < {p.least_words}, 100 * len(list_distinct(ws)) < {p.distinct_percent} * len(ws), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {p.capital_percent} * length(t),
  regexp_matches(t, '[{marks}]'), COALESCE(doc_id > least, FALSE)] AS fails FROM w),
lb AS (SELECT doc_id, COALESCE(MAX((quality = 1)::INT), 0) AS good, COALESCE(MAX((toxic = 1)::INT), 0) AS toxic FROM labels GROUP BY 1),
x AS (SELECT part, fails, COUNT(*) AS n, COALESCE(SUM(good), 0) AS good, COALESCE(SUM(toxic), 0) AS toxic FROM f LEFT JOIN lb USING (doc_id) GROUP BY 1, 2),
letters AS (SELECT chr(65 + i::INT) AS c FROM range({k}) r(i)),
o AS (SELECT {orders} AS filter_order, s.i::INTEGER AS step FROM {letters}, range(1, {k + 1}) s(i) WHERE {other}),
y AS (SELECT part, filter_order, step, {count("n", passed("step"))} AS kept, {count("n", f"{here} AND {passed('(step - 1)')}")} AS removed, {count("n", f"{here} AND NOT ({passed('(step - 1)')})")} AS redundant,
  {count("n", f"{here} AND len(list_filter(fails, lambda b: b)) = 1")} AS unique_fails, {count("good", f"{here} AND {passed('(step - 1)')}")} AS good_lost, {count("toxic", f"{here} AND {passed('(step - 1)')}")} AS toxic_lost
  FROM x, o GROUP BY 1, 2, 3)
SELECT *, (SUM(removed) OVER (PARTITION BY part, filter_order[step]))::BIGINT AS shapley FROM y"""


def near_sql(source: str, shingle: int = 5, num: int = 4, den: int = 5) -> str:
    """Shared shingles counted by pair, and the smallest id that each document reaches: those that stay."""
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(COALESCE(text, ''), '{UPPER}', '{LOWER}'), '{SPACES}'), lambda y: y <> '') AS ws FROM {source}),
g AS (SELECT DISTINCT doc_id, ws[i:i + {shingle - 1}] AS g FROM (SELECT doc_id, ws, unnest(range(1, GREATEST(len(ws) - {shingle - 2}, 2))) AS i FROM w)),
n AS (SELECT doc_id, COUNT(*) AS n FROM g GROUP BY 1),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS c FROM g x JOIN g y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE {den} * c >= {num} * (x.n + y.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT a AS doc_id FROM r GROUP BY 1 HAVING MIN(b) = a"""


def pipeline_sql() -> str:
    """The stages in turn, each over what the one before kept."""
    over = lambda sql, source: sql.replace("FROM documents", f"FROM {source}")
    cut = "list_filter(list_zip(range(len(ls)), ls), lambda z: NOT list_contains(string_split(removed, ','), z[1]::VARCHAR))"
    return f"""
WITH s1 AS MATERIALIZED (SELECT d.* FROM documents d JOIN ({quality_sql()}) q USING (doc_id) WHERE q.kept),
k2 AS MATERIALIZED ({over(lines_sql(), "s1")}),
c2 AS MATERIALIZED (SELECT s1.* REPLACE (CASE WHEN n_removed = 0 THEN text ELSE array_to_string(list_transform({cut}, lambda z: z[2]), chr(10)) END AS text), n_removed FROM (SELECT *, string_split(text, chr(10)) AS ls FROM s1) s1 JOIN k2 USING (doc_id)),
s2 AS MATERIALIZED (SELECT doc_id, text, lang, source, n_chars FROM c2 WHERE n_removed = 0 OR regexp_matches(text, '[^ \\t\\n\\x0B\\f\\r]')),
s3 AS MATERIALIZED (SELECT s2.* FROM s2 JOIN ({near_sql("s2")}) k USING (doc_id)),
s4 AS MATERIALIZED (SELECT s3.* FROM s3 JOIN ({over(leaks_sql(), "s3")}) k USING (doc_id) WHERE NOT contaminated),
m5 AS MATERIALIZED ({over(mixing_sql(), "s4")})
SELECT s4.*, rate AS mix_rate, copies AS mix_copies FROM s4 JOIN (SELECT doc_id, rate, copies FROM m5) m USING (doc_id), range(1000) c(i) WHERE c.i < copies"""
