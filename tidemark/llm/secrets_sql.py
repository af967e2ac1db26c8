"""The secret scan (operator 9) in DuckDB SQL: the same patterns, battery and false-discovery control."""

from __future__ import annotations

# Written apart from the Spark code, so that one is held against the other.
_LOW, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"
_USUAL = "etaoinshrdlcumwfgypbvkjxqz"  # by frequency in text
_LETTERS = (
    ("[a-z]", _USUAL),
    ("[A-Z]", _USUAL.upper()),
    ("[A-Z2-7]", _LOW.upper() + "234567"),
    ("[A-Za-z]", _USUAL + _USUAL.upper()),
    ("[A-Za-z+/]", _USUAL + "+/" + _USUAL.upper()),
    ("[A-Za-z_-]", _USUAL + "-_" + _USUAL.upper()),
)
_BASE62 = _LOW.upper() + _LOW + _DIGITS
_OTHER = (
    ("[0-9a-z]", _DIGITS + _LOW),
    ("[0-9A-Z]", _DIGITS + _LOW.upper()),
    ("[0-9A-Za-z]", _BASE62),
    ("[0-9A-Za-z+/]", _BASE62 + "+/"),
    ("[0-9A-Za-z_-]", _BASE62 + "-_"),
)
_SMALL = (("[0-9a-f]", "0123456789abcdef"), ("[0-9A-F]", "0123456789ABCDEF"))
_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
# kind, order, pattern, and what a match must hold
_PATTERNS = (
    ("assign", 0, _ASSIGN, f"length(regexp_extract(hit, '{_ASSIGN}', 2)) >= 6"),
    ("access", 1, "AKIA[A-Z0-9]+", "length(hit) >= 20"),
    ("hex", 2, "[0-9a-f]+", "length(hit) >= 24"),
    ("random", 3, "[A-Za-z0-9+/_-]+", "length(hit) >= 20 AND regexp_matches(hit, '[A-Za-z]')"),
)
_SEARCH = " UNION ALL ".join(
    f"SELECT doc_id, '{kind}' AS kind, {order} AS ord, string_split_regex(text, '{p}') AS gaps, regexp_extract_all(text, '{p}') AS hits FROM d"
    for kind, order, p, _ in _PATTERNS
)
_HOLDS = " OR ".join(f"(kind = '{kind}' AND {cond})" for kind, _, _, cond in _PATTERNS)
_ALPHABET = "CASE " + " ".join(f"WHEN regexp_matches(hit, '^{p}+$') THEN '{abc}'" for p, abc in (*_SMALL, *_LETTERS, *_OTHER)) + f" ELSE '{_BASE62}+/-_' END"
_BAND = "(n >= 32)::INT + (n >= 64)::INT + (n >= 128)::INT + (n >= 256)::INT"


def _upper(z: str) -> str:
    z = f"greatest(least({z}, 30.0), -30.0)"
    return f"(1 / (1 + exp(1.5976 * {z} + 0.07056 * {z} * {z} * {z})))"


def _two(z: str) -> str:
    return f"least(2 * {_upper(f'abs({z})')}, 1.0)"


SECRETS_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
searched AS ({_SEARCH}),
cut AS (SELECT doc_id, kind, ord, unnest(gaps) AS gap, unnest(hits) AS hit, unnest(range(1, len(gaps) + 1)) AS i FROM searched),
placed AS (
    SELECT doc_id, kind, ord, hit,
        sum(length(gap)) OVER (PARTITION BY doc_id, kind ORDER BY i)
        + coalesce(sum(length(hit)) OVER (PARTITION BY doc_id, kind ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
    FROM cut),
found AS (SELECT *, s + length(hit) AS e FROM placed WHERE hit IS NOT NULL AND hit <> '' AND ({_HOLDS})),
token AS (
    SELECT doc_id, s, e, hit, CAST(length(hit) AS DOUBLE) AS n, {_ALPHABET} AS abc FROM found t
    WHERE ord = 3 AND NOT EXISTS (SELECT 1 FROM found b WHERE b.ord < 3 AND b.doc_id = t.doc_id AND b.s < t.e AND t.s < b.e)),
t1 AS (
    SELECT *, CAST(length(abc) AS DOUBLE) AS a, [CAST(instr(abc, c) - 1 AS DOUBLE) for c in string_split(hit, '')] AS v,
        list_sum([power(n - length(replace(hit, c, '')), 2) for c in string_split(abc, '')]) AS squares FROM token),
t2 AS (
    SELECT *, list_sum(v) / n AS mv, CAST(len([x for x in v if x >= a / 2]) AS DOUBLE) AS high,
        1.0 + len([i for i in range(1, len(v)) if (v[i] >= a / 2) <> (v[i + 1] >= a / 2)]) AS runs,
        greatest(squares * a / n - n, 0.0) AS chi, 2 / (9 * (a - 1)) AS part FROM t1),
t3 AS (
    SELECT *, 2 * high * (n - high) / n + 1 AS mean, list_sum([power(x - mv, 2) for x in v]) AS spread,
        list_sum([(v[i] - mv) * (v[i + 1] - mv) for i in range(1, len(v))]) AS lag FROM t2),
t4 AS (SELECT *, (mean - 1) * (mean - 2) / (n - 1) AS wide, CASE WHEN spread > 0 THEN lag / spread ELSE 1.0 END AS r FROM t3),
t5 AS (
    SELECT *, {_upper("((power(chi / (a - 1), 1 / 3.0) - (1 - part)) / sqrt(part))")} AS cells,
        {_two("((2 * high - n) / sqrt(n))")} AS halves,
        CASE WHEN wide <= 0 THEN {_two("sqrt(n)")} ELSE {_two("((runs - mean) / sqrt(wide))")} END AS p2,
        {_two("((r + 1 / n) * sqrt(n))")} AS p3 FROM t4),
t5b AS (SELECT *, CASE WHEN instr(abc, '2') = 0 THEN least(2 * least(cells, halves), 1.0) ELSE cells END AS p1 FROM t5),
t6 AS (SELECT *, -(ln(p1) + ln(p2) + ln(p3)) AS h, {_BAND} AS band FROM t5b),
tested AS (
    SELECT *, CAST(least(floor(-log10(greatest(exp(-h) * (1 + h + h * h / 2), 1e-300)) * 50), 15000) AS INT) AS bin FROM t6),
counted AS (
    SELECT band, bin, count(*) AS n FROM tested GROUP BY band, bin UNION ALL SELECT DISTINCT band, 15001, 0 FROM tested),
ranked AS (
    SELECT *, sum(n) OVER (PARTITION BY band ORDER BY bin DESC) AS k, sum(n) OVER (PARTITION BY band) AS m, power(10.0, -bin / 50.0) AS p,
        coalesce(sum(n) FILTER (bin < 16) OVER (PARTITION BY band), 0) AS near FROM counted),
hochberg AS (
    SELECT *, m - k AS taken, min(bin) FILTER (n = 0 OR p <= 0.05 * k / m) OVER (PARTITION BY band) AS head FROM ranked),
cutoff AS (
    SELECT band, greatest(max(bin) FILTER (bin <= head AND 0.9 * taken - sqrt(taken) <= (near + 1) * (1 - p) / (1 - power(10.0, -0.32))),
        least(16, min(head))) AS least FROM hochberg GROUP BY band),
spans AS (
    SELECT doc_id, kind, ord, s, e FROM found WHERE ord < 3
    UNION ALL SELECT doc_id, 'random', 3, s, e FROM tested LEFT JOIN cutoff USING (band) WHERE least IS NULL OR bin < least),
written AS (
    SELECT doc_id, count(*) FILTER (ord = 0) AS n_assign, count(*) FILTER (ord = 1) AS n_access, count(*) FILTER (ord = 2) AS n_hex,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord) FILTER (ord < 3) AS base,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, ord) AS spans
    FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN written USING (doc_id)
"""
