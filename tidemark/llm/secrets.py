"""Secret scan with a battery of randomness tests (operator 9), in Spark expressions only.

Three fixed patterns find assignments, access keys and long hexadecimal
strings; their matches are always reported. Besides them, every long token
with a letter is tested for being random (one of digits and signs alone is a
number or a rule; of 20 random hex characters 8 in 100,000 are all digits):

* its encoding is inferred: the smallest alphabet that has all its characters,
  of hex, base32, base36, base62, base64 and base64url or their letters;
* under "characters are drawn uniformly from that alphabet", three p-values
  come from a chi-squared test of the alphabet's use (Wilson-Hilferty), a
  two-sided runs test about the alphabet's middle, and a two-sided test of
  the serial correlation at lag one; Fisher's method joins them. Alphabets
  without digits are in the order of the letters' frequency, small before
  capital ones, and the chi-squared test is also made over their two halves
  (twice the lesser p-value counts): 20 letters are few for 26 or 52 cells,
  but words keep to the frequent half;
* Benjamini-Hochberg, applied to all tokens of the table in each band of
  lengths (a short token says less, so it is not held to the evidence of long
  ones), rejects the hypothesis for tokens that are not random, at a false
  discovery rate of ``RATE``, which limits lost secrets. To limit false ones,
  the number of random tokens is estimated from the p-values near one, where
  there are few others (Storey), and the cut-off moves up until tokens beyond
  that number are at most ``FALSE`` of those accepted, chance (a standard
  error) aside. Tokens that are not rejected are secrets.

Positions are code points, found by splitting a text at the matches and
adding up lengths. Normal tails use the logistic approximation
``1 / (1 + exp(1.5976 z + 0.07056 z**3))``.

Scale. One pass over the texts counts tokens by band and rounded p-value, a
table of at most ``len(BANDS) * MAX_BIN`` rows; spans follow from what that
pass wrote, with the few cut-offs as constants. No text is shuffled. Work
grows with a text's characters, also if it has many matches: running sums and
maxima are taken in blocks, so that no long array grows item by item.

Edge cases. A null text is empty. Rows that repeat are scanned each. An empty
table gives an empty result. Other columns pass through :func:`redact`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import packed, settled

# The patterns of the contract.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
KINDS = ("assign", "access", "hex", "random")
MIN_VALUE = 6
MASK = "[SECRET]"

RATE, FALSE = 0.05, 0.1
#: Token lengths at which a new band begins.
BANDS = (20, 32, 64, 128, 256)
#: p-values are rounded up to powers of 10 ** (-1 / STEP), down to 10 ** (-MAX_BIN / STEP).
STEP, MAX_BIN = 50, 15_000
#: Bins below this one (p above 0.48) tell how many tokens are random.
NEAR_ONE = 16

_DIGITS, _LOW, _UP = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Small letters from the most to the least frequent one in text.
_USUAL = "etaoinshrdlcumwfgypbvkjxqz"
ALPHABETS = (
    ("^[0-9a-f]+$", _DIGITS + _LOW[:6]),
    ("^[0-9A-F]+$", _DIGITS + _UP[:6]),
    ("^[a-z]+$", _USUAL),
    ("^[A-Z]+$", _USUAL.upper()),
    ("^[A-Z2-7]+$", _UP + _DIGITS[2:8]),
    ("^[A-Za-z]+$", _USUAL + _USUAL.upper()),
    ("^[A-Za-z+/]+$", _USUAL + "+/" + _USUAL.upper()),
    ("^[A-Za-z_-]+$", _USUAL + "-_" + _USUAL.upper()),
    ("^[0-9a-z]+$", _DIGITS + _LOW),
    ("^[0-9A-Z]+$", _DIGITS + _UP),
    ("^[0-9A-Za-z]+$", _UP + _LOW + _DIGITS),
    ("^[0-9A-Za-z+/]+$", _UP + _LOW + _DIGITS + "+/"),
    ("^[0-9A-Za-z_-]+$", _UP + _LOW + _DIGITS + "-_"),
)
_ANY = _UP + _LOW + _DIGITS + "+/-_"

_SPAN = "array<struct<start:int,kind:int,end:int,token:string>>"
_BLOCK = 128


def _bound(x: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of ``x``, which is worked out once however often ``fn`` names it."""
    return F.transform(F.array(x), fn)[0]


def _running(x: Column, join: Callable[[Column, Column], Column], levels: int = 1) -> Column:
    """Running ``join`` (sum, maximum) of an array of int, in blocks (more levels make blocks of blocks)."""

    def plain(part: Column) -> Column:
        empty = F.array().cast("array<int>")
        last = lambda a, v: F.when(F.size(a) > 0, join(F.get(a, F.size(a) - 1), v)).otherwise(v)
        return F.aggregate(part, empty, lambda a, v: F.concat(a, F.array(last(a, v))))

    if not levels:
        return plain(x)

    def blocks(x: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(x), F.lit(1)), F.lit(_BLOCK))
        return _bound(F.transform(starts, lambda i: plain(F.slice(x, i, _BLOCK))), after)

    def after(parts: Column) -> Column:
        until = _running(F.transform(parts, lambda p: F.get(p, F.size(p) - 1)), join, levels - 1)
        return _bound(until, lambda u: F.flatten(F.transform(parts, lambda p, i: F.when(i > 0, F.transform(p, lambda v: join(F.get(u, i - 1), v))).otherwise(p))))

    return _bound(x, blocks)


def _add(a: Column, b: Column) -> Column:
    return a + b


def _matches(text: Column, pattern: str, kind: int) -> Column:
    """``start, kind, end, token`` of each match; positions are code points."""
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.filter(F.arrays_zip(gaps.alias("gap"), hits.alias("hit")), lambda x: x["hit"].isNotNull())

    def placed(pairs: Column) -> Column:
        ends = _running(F.transform(pairs, lambda x: F.length(x["gap"]) + F.length(x["hit"])), _add)
        return F.zip_with(pairs, ends, lambda x, end: F.struct((end - F.length(x["hit"])).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), x["hit"].alias("token")))

    return F.when(text.rlike(pattern), _bound(pairs, placed)).otherwise(F.from_json(F.lit("[]"), _SPAN))


def _apart(tokens: Column, base: Column) -> Column:
    """The tokens that touch no base span."""

    def marked(all_: Column) -> Column:
        own = lambda t, value: F.when(t["kind"] < 3, value).otherwise(F.lit(-(1 << 30)))
        until = _running(F.transform(all_, lambda t: own(t, t["end"])), F.greatest)  # the furthest end of base spans that begin before
        later = F.reverse(_running(F.transform(F.reverse(all_), lambda t: own(t, -t["start"])), F.greatest))  # the next base span's start, negative
        return F.zip_with(F.zip_with(all_, until, lambda t, u: F.struct(t.alias("t"), u.alias("u"))), later, lambda x, v: F.struct(x["t"], x["u"], v.alias("v")))

    rows = _bound(F.array_sort(F.concat(tokens, base)), marked)
    free = F.filter(rows, lambda x: (x["t"]["kind"] == 3) & (x["u"] <= x["t"]["start"]) & (-x["v"] >= x["t"]["end"]))
    return F.when((F.size(tokens) > 0) & (F.size(base) > 0), F.transform(free, lambda x: x["t"])).otherwise(tokens)


def _alphabet(token: Column) -> Column:
    out = None
    for pattern, letters in ALPHABETS:
        out = F.when(token.rlike(pattern), letters) if out is None else out.when(token.rlike(pattern), letters)
    return out.otherwise(_ANY)


def _upper(z: Column) -> Column:
    """P(normal > z)."""
    z = F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))


def _battery(tokens: Column) -> Column:
    """Each span's length band and rounded joint p-value: ``start, kind, end, band, bin``."""
    x = F.transform(tokens, lambda t: F.struct(t["start"], t["kind"], t["end"], t["token"], _alphabet(t["token"]).alias("abc"), F.length(t["token"]).cast("double").alias("n")))
    x = F.transform(x, lambda t: F.struct(
        t["start"], t["kind"], t["end"], t["n"], F.length(t["abc"]).cast("double").alias("a"), (~t["abc"].contains("2")).alias("letters"),
        F.transform(F.split(t["token"], ""), lambda c: F.instr(t["abc"], c).cast("double") - 1).alias("v"),
        F.aggregate(F.split(t["abc"], ""), F.lit(0.0), lambda s, c: s + F.pow(t["n"] - F.length(F.replace(t["token"], c, F.lit(""))), F.lit(2))).alias("squares"),
    ))
    x = F.transform(x, lambda t: F.struct(
        t["start"], t["kind"], t["end"], t["n"], t["a"], t["letters"], t["v"], t["squares"],
        F.size(F.filter(t["v"], lambda v: v >= t["a"] / 2)).cast("double").alias("high"),
        F.aggregate(t["v"], F.lit(0.0), lambda s, v: s + v).alias("sum"),
        F.zip_with(F.slice(t["v"], F.lit(1), F.size(t["v"]) - 1), F.slice(t["v"], F.lit(2), F.size(t["v"]) - 1), lambda p, q: F.struct(p.alias("p"), q.alias("q"))).alias("next"),
    ))
    x = F.transform(x, lambda t: F.struct(
        t["start"], t["kind"], t["end"], t["n"], t["a"], t["letters"], t["squares"], t["high"],
        (1 + F.size(F.filter(t["next"], lambda y: (y["p"] >= t["a"] / 2) != (y["q"] >= t["a"] / 2)))).cast("double").alias("runs"),
        F.aggregate(t["v"], F.lit(0.0), lambda s, v: s + F.pow(v - t["sum"] / t["n"], F.lit(2))).alias("spread"),
        F.aggregate(t["next"], F.lit(0.0), lambda s, y: s + (y["p"] - t["sum"] / t["n"]) * (y["q"] - t["sum"] / t["n"])).alias("lag"),
    ))
    x = F.transform(x, lambda t: F.struct(t["start"], t["kind"], t["end"], t["n"], _uniform(t).alias("p1"), _runs(t).alias("p2"), _serial(t).alias("p3")))
    x = F.transform(x, lambda t: F.struct(t["start"], t["kind"], t["end"], t["n"], (-(F.ln(t["p1"]) + F.ln(t["p2"]) + F.ln(t["p3"]))).alias("h")))
    band = lambda n: sum((F.when(n >= b, 1).otherwise(0) for b in BANDS[1:]), F.lit(0))
    # Fisher: twice h is chi-squared with six degrees of freedom
    joint = lambda h: F.exp(-h) * (1 + h + h * h / 2)
    return F.transform(x, lambda t: F.struct(
        t["start"], t["kind"], t["end"], band(t["n"]).cast("int").alias("band"),
        F.least(F.floor(-F.log10(F.greatest(joint(t["h"]), F.lit(1e-300))) * STEP), F.lit(MAX_BIN)).cast("int").alias("bin"),
    ))


def _uniform(t: Column) -> Column:
    free = t["a"] - 1
    chi = t["squares"] * t["a"] / t["n"] - t["n"]
    part = 2 / (9 * free)
    cells = _upper((F.pow(F.greatest(chi, F.lit(0.0)) / free, F.lit(1 / 3)) - (1 - part)) / F.sqrt(part))
    halves = _two_sided((2 * t["high"] - t["n"]) / F.sqrt(t["n"]))
    return F.when(t["letters"], F.least(2 * F.least(cells, halves), F.lit(1.0))).otherwise(cells)


def _two_sided(z: Column) -> Column:
    return F.least(2 * _upper(F.abs(z)), F.lit(1.0))


def _runs(t: Column) -> Column:
    mean = 2 * t["high"] * (t["n"] - t["high"]) / t["n"] + 1
    spread = (mean - 1) * (mean - 2) / (t["n"] - 1)
    return F.when(spread <= 0, _two_sided(F.sqrt(t["n"]))).otherwise(_two_sided((t["runs"] - mean) / F.sqrt(spread)))


def _serial(t: Column) -> Column:
    r = F.when(t["spread"] > 0, t["lag"] / t["spread"]).otherwise(F.lit(1.0))
    return _two_sided((r + 1 / t["n"]) * F.sqrt(t["n"]))


def found(rows: DataFrame) -> DataFrame:
    """Adds ``base``, the fixed patterns' spans in order, and ``tests``, the tested tokens, to a table with ``text``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    assign = F.filter(_matches(text, ASSIGN, 0), lambda t: F.length(F.regexp_extract(t["token"], ASSIGN, 2)) >= MIN_VALUE)
    base = F.array_sort(F.concat(assign, _matches(text, ACCESS, 1), _matches(text, HEX, 2)))
    rows = rows.withColumn("base", base).withColumn("tokens", F.filter(_matches(text, TOKEN, 3), lambda t: t["token"].rlike("[A-Za-z]")))
    rows = rows.withColumn("tokens", _apart(F.col("tokens"), F.col("base")))
    return rows.withColumn("tests", F.when(F.size("tokens") > 0, _battery(F.col("tokens"))).otherwise(F.from_json(F.lit("[]"), "array<struct<start:int,kind:int,end:int,band:int,bin:int>>"))).drop("tokens")


def cutoffs(rows: DataFrame, rate: float = RATE, false: float = FALSE) -> dict[int, int]:
    """For each band, the least bin whose tokens are rejected as not random."""
    counts = rows.select(F.explode("tests").alias("t")).groupBy("t.band", "t.bin").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.unionByName(counts.select("band", F.lit(MAX_BIN + 1).alias("bin"), F.lit(0).cast("bigint").alias("n")).distinct())
    own = Window.partitionBy("band")
    ranked = counts.withColumn("k", F.sum("n").over(own.orderBy(F.desc("bin")))).withColumn("m", F.sum("n").over(own))
    ranked = ranked.withColumn("near", F.sum(F.when(F.col("bin") < NEAR_ONE, F.col("n")).otherwise(0)).over(own))
    p, taken = F.pow(F.lit(10.0), -F.col("bin") / STEP), F.col("m") - F.col("k")
    # Benjamini-Hochberg; the row without tokens stands for "none is rejected"
    ranked = ranked.withColumn("first", F.min(F.when((p <= rate * F.col("k") / F.col("m")) | (F.col("n") == 0), F.col("bin"))).over(own))
    random = (F.col("near") + 1) * (1 - p) / (1 - 10.0 ** (-NEAR_ONE / STEP))
    fits = (F.col("bin") <= F.col("first")) & (taken - F.sqrt(taken) - false * taken <= random)
    floor = F.least(F.lit(NEAR_ONE), F.min("first"))
    least = ranked.groupBy("band").agg(F.greatest(F.max(F.when(fits, F.col("bin"))), floor).alias("bin"))
    return {r.band: r.bin for r in least.collect()}  # a row for each band at most


def accepted(cut: dict[int, int]) -> Column:
    """All spans in order: the base ones and the tokens that pass for random."""
    limit = F.lit(MAX_BIN + 1)
    of = lambda t: F.coalesce(*[F.when(t["band"] == b, F.lit(c)) for b, c in sorted(cut.items())], limit)
    strip = lambda t: F.struct(t["start"].alias("start"), t["kind"].alias("kind"), t["end"].alias("end"))
    random = F.transform(F.filter("tests", lambda t: t["bin"] < of(t)), strip)
    return F.array_sort(F.concat(F.transform("base", strip), random))


def written(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    kind = lambda t: F.element_at(F.array(*[F.lit(k) for k in KINDS]), t["kind"] + 1)
    return F.array_join(F.transform(spans, lambda t: F.concat_ws(":", kind(t), t["start"].cast("string"), t["end"].cast("string"))), ",")


def scan(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """``doc_id, base, spans`` of every document: arrays of ``start, kind, end``."""
    rows = settled(found(docs.select("doc_id", "text")).select("doc_id", "base", "tests"), "secrets")
    return rows.withColumn("spans", accepted(cutoffs(rows, rate))).select("doc_id", "base", "spans")


def redact(docs: DataFrame, rate: float = RATE, mask: str = MASK) -> DataFrame:
    """The documents with each secret's span replaced by ``mask``; ``n_chars``, where there is one, follows."""
    rows = settled(found(packed(docs)).select("row", "base", "tests"), "redact")
    rows = rows.withColumn("spans", accepted(cutoffs(rows, rate)))
    text = F.col("row.text").cast("string")
    # a place in UTF-32 bytes is found at once; the leading space keeps a text's own U+FEFF from being read as a byte order mark
    part = lambda b, start, n: F.substring(F.decode(F.concat(F.lit(bytearray(b"\0\0\0 ")), F.substring(b, 4 * start + 1, 4 * n)), "UTF-32"), F.lit(2), n)

    def cleaned(x: Column) -> Column:
        before = lambda i: F.coalesce(F.get(x["ends"], i - 1), F.lit(0))
        gap = lambda t, i: F.when(t["start"] >= before(i), F.concat(part(x["b"], before(i), t["start"] - before(i)), F.lit(mask))).otherwise("")
        last = F.element_at(x["ends"], -1)
        return F.concat(F.array_join(F.transform("spans", gap), ""), part(x["b"], last, (F.octet_length(x["b"]) / 4).cast("int") - last))

    ends = _running(F.transform("spans", lambda t: t["end"]), F.greatest)
    clean = _bound(F.struct(ends.alias("ends"), F.encode(text, "UTF-32").alias("b")), cleaned)
    rows = rows.withColumn("clean", F.when(F.size("spans") > 0, clean).otherwise(text))
    new = {"text": F.col("clean"), "n_chars": F.when(F.size("spans") > 0, F.length("clean")).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return rows.select(*[new[c].cast(t).alias(c) if new.get(c) is not None else F.col(f"row.`{c}`").alias(c) for c, t in docs.dtypes])
