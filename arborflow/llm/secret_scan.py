"""Secrets in texts: three base patterns, and long tokens that pass a battery of randomness tests.

Each token of 20 or more characters gets an encoding by its characters. Three tests ask whether it is drawn at
random from that alphabet: chi-squared uniformity of its characters, runs about the alphabet's middle, and serial
correlation of neighbours. Natural words fail them, short ones only sometimes, so the smallest accepted p-value is
set per encoding and length class: the expected share of natural tokens among the accepted ones stays below a level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborflow.llm.columns import LOWER, UPPER, found_spans, let
from arborflow.session import written

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
DIGITS = "0123456789"
#: encoding, pattern of its tokens, alphabet; the first that fits is taken
ENCODINGS = (
    ("digits", "^[0-9]+$", DIGITS),
    ("hex", "^[0-9a-f]+$", DIGITS + "abcdef"),
    ("HEX", "^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("lower", "^[a-z]+$", LOWER),
    ("upper", "^[A-Z]+$", UPPER),
    ("base32", "^[A-Z2-7]+$", UPPER + "234567"),
    ("letters", "^[A-Za-z]+$", UPPER + LOWER),
    ("base36", "^[a-z0-9]+$", DIGITS + LOWER),
    ("BASE36", "^[A-Z0-9]+$", DIGITS + UPPER),
    ("base62", "^[A-Za-z0-9]+$", DIGITS + UPPER + LOWER),
    ("base64", "", UPPER + LOWER + DIGITS + "+/_-"),
)
NATURAL = ("lower", "upper", "letters")  # what these hold is taken for words
LENGTHS = (24, 28, 32, 48, 64)  # first lengths of the classes after the first
CUTS = (0.001, 0.01, 0.05, 0.1, 0.2, 0.4)
FALSE_SHARE = 0.05


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal, within 2e-4, by a logistic curve."""
    return 1 / (1 + F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), 1.5976 * z + 0.07056 * z * z * z))))


def _tests(token: Column, alphabet: Column) -> Column:
    """Combined p-value (Bonferroni over three tests) of being uniform and independent over the alphabet."""

    def of(chars):
        n, a = F.size(chars), F.length(alphabet)
        squares = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda s, c: s + F.pow(n - F.length(F.replace(token, c, F.lit(""))), F.lit(2.0)))
        spread = 2 / (9 * (a - 1))
        chi = let(a / n * squares - n, lambda x: _upper_tail((F.pow(F.greatest(x, F.lit(0.0)) / (a - 1), F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread)))
        zero, one = F.lit(0.0), F.lit(0.0)
        start = F.struct(F.lit(-1.0).alias("last"), F.lit(0.0).alias("runs"), one.alias("high"), zero.alias("s"), zero.alias("ss"), zero.alias("sx"))

        def step(t, c):
            x = F.instr(alphabet, c).cast("double") - 1
            side = lambda v: (v >= a / 2).cast("double")
            return let(
                x,
                lambda x: F.struct(
                    x.alias("last"),
                    (t["runs"] + F.when((t["last"] < 0) | (side(t["last"]) != side(x)), 1.0).otherwise(0.0)).alias("runs"),
                    (t["high"] + side(x)).alias("high"),
                    (t["s"] + x).alias("s"),
                    (t["ss"] + x * x).alias("ss"),
                    (t["sx"] + F.when(t["last"] < 0, 0.0).otherwise(t["last"] * x)).alias("sx"),
                ),
            )

        def finish(t):
            first = F.instr(alphabet, chars[0]).cast("double") - 1
            mean = t["s"] / n
            expected = 1 + 2 * t["high"] * (n - t["high"]) / n
            variance = F.greatest((expected - 1) * (expected - 2) / (n - 1), F.lit(1e-9))
            one_sided = (t["high"] == 0) | (t["high"] == n)
            runs = F.when(one_sided, 0.0).otherwise(2 * _upper_tail(F.abs(t["runs"] - expected) / F.sqrt(variance)))
            varied = t["ss"] - n * mean * mean
            lagged = t["sx"] - mean * (2 * t["s"] - first - t["last"]) + (n - 1) * mean * mean
            serial = F.when(varied <= 1e-9, 0.0).otherwise(2 * _upper_tail(F.abs(lagged / varied) * F.sqrt(n.cast("double"))))
            return F.least(F.lit(1.0), 3 * F.least(chi, runs, serial))

        return let(F.aggregate(chars, start, step), finish)

    return let(F.regexp_extract_all(token, F.lit("(?s)."), F.lit(0)), of)


def _candidates(text: Column) -> Column:
    """start, end, encoding, length class and p-value of each long token."""

    def encoding(token):
        chosen = F.lit(len(ENCODINGS) - 1)
        for number, (_, pattern, _) in reversed(list(enumerate(ENCODINGS[:-1]))):
            chosen = F.when(token.rlike(pattern), number).otherwise(chosen)
        return chosen

    alphabets = F.array(*[F.lit(alphabet) for *_, alphabet in ENCODINGS])
    size = lambda s: sum(((s["end"] - s["start"]) >= least).cast("int") for least in LENGTHS)
    return F.transform(
        found_spans(text, TOKEN),
        lambda s: let(
            encoding(s["value"]),
            lambda e: F.struct(s["start"].alias("start"), s["end"].alias("end"), e.alias("encoding"), size(s).alias("size"), _tests(s["value"], alphabets[e]).alias("p")),
        ),
    )


def smallest_accepted(counts: dict) -> dict:
    """(encoding, size class): smallest accepted p-value, of token counts by (encoding, size class, number of cuts reached).

    In a class, natural tokens are counted by their failures at the first cut; how many of them reach a further cut
    is learned from tokens of letters only, of the same length. A class whose accepted tokens would be natural in
    more than FALSE_SHARE of cases at every cut accepts none, and neither does an encoding of letters only.
    """
    accepted = {}
    for encoding, size in {(e, s) for e, s, _ in counts}:
        if ENCODINGS[encoding][0] in NATURAL:
            continue
        words = [sum(n for (e, s, c), n in counts.items() if ENCODINGS[e][0] in NATURAL and s == size and c >= cut) for cut in range(len(CUTS) + 1)]
        own = [sum(n for (e, s, c), n in counts.items() if (e, s) == (encoding, size) and c >= cut) for cut in range(len(CUTS) + 1)]
        missed = [(w + 1) / (words[0] + 1) for w in words]
        natural = (own[0] - own[1]) / max(0.05, 1 - missed[1])
        for cut in range(1, len(CUTS) + 1):
            if own[cut] and natural * missed[cut] / own[cut] <= FALSE_SHARE:
                accepted[encoding, size] = CUTS[cut - 1]
                break
    return accepted


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans (kind, start, end; code points, end exclusive; by start, then kind) of every row.

    One pass over the texts keeps only spans; counts by encoding, length class and p-value (at most a few hundred
    numbers) set the accepted p-values; a projection applies them. A random token inside a base span is not listed
    again. A null or empty text has no spans; repeated rows each come back; an empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    spanned = lambda spans, rank: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end")))
    assigned = F.filter(found_spans(text, ASSIGN, 1), lambda s: F.length(s["value"]) >= 8)
    base = F.concat(spanned(assigned, 0), spanned(found_spans(text, ACCESS), 1), spanned(found_spans(text, HEX), 2))
    rows = docs.select(F.col(id_col).alias("doc_id"), base.alias("base"), _candidates(text).alias("tokens"))
    rows = written(rows, "secret-spans")

    token = rows.select(F.explode("tokens").alias("t"))
    reached = sum((F.col("t.p") >= cut).cast("int") for cut in CUTS)
    counts = token.groupBy(F.col("t.encoding").alias("e"), F.col("t.size").alias("s"), reached.alias("c")).count().collect()
    accepted = smallest_accepted({(r["e"], r["s"], r["c"]): r["count"] for r in counts})
    least = F.create_map(*[F.lit(v) for (e, s), p in {(-1, 0): 2.0, **accepted}.items() for v in (e * 100 + s, p)])
    random = F.filter("tokens", lambda t: t["p"] >= F.coalesce(least[t["encoding"] * 100 + t["size"]], F.lit(2.0)))
    random = F.filter(random, lambda t: ~F.exists("base", lambda b: (b["start"] <= t["start"]) & (t["end"] <= b["end"])))
    spans = F.array_sort(F.concat("base", spanned(random, 3)))
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return rows.select("doc_id", F.transform(spans, lambda s: F.struct(names[s["rank"]].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
