"""Secret scan: three fixed kinds, and a battery of randomness tests on other long tokens.

Everything is built from column functions, row by row; only a table of at most ``MOST_BINS`` counts is aggregated.

The battery. A token of ``SHORTEST`` characters or more outside the fixed kinds gets the narrowest encoding that its
characters allow (hexadecimal, base 32, base 64). Its symbols are tested for being uniform and independent:
chi-squared of the symbol counts, number of runs about the middle, and serial correlation at lag one; Fisher's method
joins the three p-values. A token whose randomness is rejected at ``REJECT`` is no secret.
Short tokens pass such tests easily, so a second condition needs evidence against ordinary text: the likelihood ratio of
the uniform encoding to a plain text model. Its reciprocal bounds a p-value (Markov), and it grows with length. Those
p-values go through the Benjamini-Hochberg procedure at ``FALSE_DISCOVERIES``, separately for each doubling of length, so
that many short tokens do not use up the error budget of long ones. Ranks come from counts per quarter of a unit of log
likelihood, which is on the safe side of the exact procedure.

Defined results: a null text counts as empty and yields a row without spans; positions are code points, end exclusive;
equal rows get equal results; other columns are ignored. The counts of the procedure cover all rows given.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.common import whole_text, written

SHORTEST = 20
REJECT = 1e-3
FALSE_DISCOVERIES = 0.01
BIN = 0.25
MOST_EVIDENCE = 60.0
LENGTH_CLASSES = 32
MOST_BINS = int(MOST_EVIDENCE / BIN + 1) * LENGTH_CLASSES

KINDS = ("assign", "access", "hex", "random")


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


NAMES = [_either_case(w) for w in ("password", "passwd", "secret", "token")] + [
    _either_case("api") + "_?" + _either_case("key")
]
ASSIGN = "(" + "|".join(NAMES) + ")" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A greedy run that is too short fails as a whole, so these two state their least length at once.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
TOKEN = "[A-Za-z0-9+/_-]{%d,}={0,2}" % SHORTEST
LEAST_VALUE = 6

ALPHABETS = {
    "hex": ("^(?:[0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    "base32": ("^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    "base64": ("^[A-Za-z0-9+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    "base64url": ("^[A-Za-z0-9_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
}
# The plain text model: share of each character class in ordinary words and names, and the size of the class.
PLAIN = {"lower": ("[a-z]", 0.93, 26), "upper": ("[A-Z]", 0.04, 26), "digit": ("[0-9]", 0.02, 10), "sign": ("[+/_-]", 0.01, 4)}

PLACE = "struct<start:int,end:int,ok:boolean,token:string>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Running totals of whole numbers under an associative ``join`` with neutral element 0.

    Lists grow by copying, so they are kept short: totals within stretches of about the root of the length, then totals
    over the stretches.
    """
    none = F.array().cast("array<int>")

    def last(totals: Column) -> Column:
        return F.coalesce(F.try_element_at(totals, F.lit(-1)), F.lit(0))

    def totals(part: Column, value: Callable[[Column], Column]) -> Column:
        return F.aggregate(part, none, lambda at, x: F.concat(at, F.array(join(last(at), value(x)))))

    def over(parts: Column) -> Column:
        carried = F.concat(F.array(F.lit(0)), totals(parts, last))
        carried = F.slice(carried, F.lit(1), F.size(parts))
        return F.flatten(F.zip_with(parts, carried, lambda part, at: F.transform(part, lambda x: join(at, x))))

    return _let(F.transform(_stretches(values), lambda part: totals(part, lambda x: x)), over)


def _stretches(values: Column) -> Column:
    """The list cut into lists of about the root of its length."""
    def cut(whole: Column) -> Column:
        step = F.greatest(F.ceil(F.sqrt(F.size(whole).cast("double"))).cast("int"), F.lit(1))
        first = F.filter(F.sequence(F.lit(0), F.floor(F.size(whole) / step).cast("int")), lambda k: k * step < F.size(whole))
        return F.transform(first, lambda k: F.slice(whole, k * step + 1, step))

    return _let(values, cut)


def _places(text: Column, pattern: str, value_group: int | None = None) -> Column:
    """Start, end and text of all matches; positions follow from the lengths of matches and of the texts between them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = found if value_group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    # The text after the last match is one element more, without a match.
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("found"), value.alias("value"))
    matches = F.filter(zipped, lambda x: x["found"].isNotNull())

    def placed(rows: Column) -> Column:
        ends = _running(F.transform(rows, lambda x: F.char_length(x["gap"]) + F.char_length(x["found"])), lambda a, b: a + b)
        return F.zip_with(rows, ends, lambda x, end: F.struct(
            (end - F.char_length(x["found"])).alias("start"), end.alias("end"),
            (F.char_length(x["value"]) >= LEAST_VALUE).alias("ok"), x["found"].alias("token"),
        ))

    return F.when(text.rlike(pattern), _let(matches, placed)).otherwise(F.array().cast(f"array<{PLACE}>"))


def _apart(tokens: Column, taken: Column) -> Column:
    """The tokens that no taken place overlaps.

    In order of places, the furthest end among those that begin before a token ends tells whether one reaches into it. Tokens do
    not overlap each other, so their order by end is their order.
    """
    def asked(token: Column) -> Column:
        return F.struct((token["end"] - 1).alias("at"), F.lit(1).alias("asks"), F.lit(0).alias("end"))

    def kept(rows: Column, others: Column) -> Column:
        begun = F.transform(others, lambda p: F.struct(p["start"].alias("at"), F.lit(0).alias("asks"), p["end"].alias("end")))
        return _let(F.sort_array(F.concat(begun, F.transform(rows, asked))), lambda events: F.transform(
            F.filter(
                F.zip_with(rows, reach_of(events), lambda t, reach: F.struct(t.alias("token"), (reach <= t["start"]).alias("free"))),
                lambda x: x["free"],
            ),
            lambda x: x["token"],
        ))

    def reach_of(events: Column) -> Column:
        reach = _running(F.transform(events, lambda e: e["end"]), F.greatest)
        both = F.zip_with(events, reach, lambda e, end: F.struct(e["asks"].alias("asks"), end.alias("end")))
        return F.transform(F.filter(both, lambda e: e["asks"] == 1), lambda e: e["end"])

    return F.when((F.size(tokens) == 0) | (F.size(taken) == 0), tokens).otherwise(
        _let(taken, lambda others: kept(tokens, others))
    )


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the normal law, by the rational approximation of the error function (error below 2e-7)."""
    def of(x: Column, z: Column) -> Column:
        def tail(t: Column) -> Column:
            series = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
            return series * F.exp(-x * x) / 2

        return _let(_let(1 / (1 + 0.3275911 * x), tail), lambda p: F.when(z >= 0, p).otherwise(1 - p))

    return _let(z, lambda v: _let(F.abs(v) / math.sqrt(2), lambda x: of(x, v)))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _randomness(values: Column, size: Column) -> Column:
    """Fisher's joined p-value of the three tests on symbol numbers 0 to size - 1."""
    n, free = F.size(values).cast("double"), size - 1.0
    squares = _sum(F.transform(
        F.sequence(F.lit(0), (size - 1).cast("int")),
        lambda s: F.pow(F.size(F.filter(values, lambda v: v == s)).cast("double"), F.lit(2.0)),
    ))
    z_chi = (F.cbrt(F.greatest(squares * size / n - n, F.lit(0.0)) / free) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
    earlier, later = F.slice(values, F.lit(1), F.size(values) - 1), F.slice(values, F.lit(2), F.size(values) - 1)
    middle, spread = (size - 1) / 2, (size * size - 1) / 12
    changes = _sum(F.zip_with(earlier, later, lambda a, b: ((a > middle) != (b > middle)).cast("double")))
    z_runs = (changes - (n - 1) / 2) / F.sqrt((n - 1) / 4)
    z_serial = _sum(F.zip_with(earlier, later, lambda a, b: (a - middle) * (b - middle))) / spread / F.sqrt(n - 1)
    tails = (_upper_tail(z_chi), 2 * _upper_tail(F.abs(z_runs)), 2 * _upper_tail(F.abs(z_serial)))
    half = -sum((F.ln(F.greatest(p, F.lit(1e-300))) for p in tails), F.lit(0.0))
    return _let(half, lambda h: F.exp(-h) * (1 + h + h * h / 2))


def _by_encoding(core: Column, value: Callable[[str, str], Column | str | float]) -> Column:
    chosen = F.lit(None)
    for name, (pattern, alphabet) in reversed(ALPHABETS.items()):
        chosen = F.when(core.rlike(pattern), value(name, alphabet)).otherwise(chosen)
    return chosen


def _judged(token: Column) -> Column:
    """Encoding, joined p-value, evidence (log likelihood ratio) and length class of a token."""
    def of_core(core: Column) -> Column:
        return _let(_by_encoding(core, lambda name, _: F.lit(name)), lambda encoding: of_encoding(core, encoding))

    def of_encoding(core: Column, encoding: Column) -> Column:
        alphabet = F.element_at(F.create_map(*[F.lit(x) for n, (_, a) in ALPHABETS.items() for x in (n, a)]), encoding)
        return _let(alphabet, lambda letters: of_letters(core, encoding, letters))

    def of_letters(core: Column, encoding: Column, letters: Column) -> Column:
        n, size = F.char_length(core).cast("double"), F.char_length(letters).cast("double")
        chars = F.filter(F.split(F.when(encoding == "hex", F.lower(core)).otherwise(core), ""), lambda c: c != "")
        numbers = F.transform(chars, lambda c: F.position(c, letters) - 1)
        plain = sum(
            (F.regexp_count(core, F.lit(pattern)).cast("double") * math.log(share / kinds) for pattern, share, kinds in PLAIN.values()),
            F.lit(0.0),
        )
        random = F.when(encoding.isNotNull(), _let(numbers, lambda v: _randomness(v, size)))
        return F.struct(
            encoding.alias("encoding"), random.alias("p_random"), (-n * F.ln(size) - plain).alias("evidence"),
            F.least(F.floor(F.log2(n)), F.lit(LENGTH_CLASSES - 1)).cast("int").alias("length_class"),
        )

    return _let(F.rtrim(token, F.lit("=")), of_core)


def _scan(rows: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, the places of the three fixed kinds, and the judged other tokens, of the column ``__text``."""
    found = rows.select(
        *keep,
        _places(F.col("__text"), ASSIGN, 2).alias("assign"),
        _places(F.col("__text"), ACCESS).alias("access"),
        _places(F.col("__text"), HEX).alias("hex"),
        _places(F.col("__text"), TOKEN).alias("tokens"),
    )
    kept = found.withColumn("assign", F.filter("assign", lambda p: p["ok"]))
    taken = F.concat("assign", "access", "hex")
    free = _apart(F.col("tokens"), taken)
    spans = [
        F.transform(k, lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"))).alias(k) for k in KINDS[:3]
    ]
    judged = F.transform(
        free, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), _judged(t["token"]).alias("judged"))
    )
    return kept.select(*keep, *spans, F.when(F.size("tokens") > 0, judged).alias("tokens"))


def scan(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, the places of the three fixed kinds, and the judged other tokens."""
    return _scan(documents.select("doc_id", whole_text().alias("__text")), ["doc_id"])


def thresholds(scanned: DataFrame) -> dict[int, float]:
    """Least evidence per length class, from one count per class and quarter of evidence: at most ``MOST_BINS`` rows."""
    judged = scanned.select(F.explode("tokens").alias("t")).select("t.judged.*").where(F.col("encoding").isNotNull())
    binned = judged.withColumn("bin", F.floor(F.greatest(F.least("evidence", F.lit(MOST_EVIDENCE)), F.lit(0.0)) / BIN))
    counts = binned.groupBy("length_class", "bin").agg(
        F.count(F.lit(1)).alias("tests"), F.count(F.when(F.col("p_random") >= REJECT, 1)).alias("random")
    )
    by_class: dict[int, list] = {}
    for row in counts.collect():
        by_class.setdefault(row["length_class"], []).append(row)
    least = {}
    for length_class, rows in by_class.items():
        tests, found = sum(r["tests"] for r in rows), 0
        for row in sorted(rows, key=lambda r: -r["bin"]):
            found += row["random"]
            if found and math.exp(-row["bin"] * BIN) <= FALSE_DISCOVERIES * found / tests:
                least[length_class] = row["bin"] * BIN
    return least


def _spans(scanned: DataFrame, least: dict[int, float]) -> Column:
    """All spans in order: places of fixed kinds, and tokens with enough evidence for their length class."""
    bar = F.create_map(*[F.lit(x) for pair in least.items() for x in pair]) if least else F.lit(None).cast("map<int,double>")
    random = F.filter(
        F.coalesce("tokens", F.array().cast(scanned.schema["tokens"].dataType)),
        lambda t: (t["judged"]["p_random"] >= REJECT)
        & (t["judged"]["evidence"] >= F.element_at(bar, t["judged"]["length_class"])),
    )

    def numbered(column: Column, kind: int) -> Column:
        return F.transform(
            column, lambda p: F.struct(p["start"].alias("start"), F.lit(kind).alias("kind"), p["end"].alias("end"))
        )

    return F.sort_array(F.concat(*[numbered(F.col(k), i) for i, k in enumerate(KINDS[:3])], numbered(random, 3)))


def find_secrets(documents: DataFrame) -> DataFrame:
    """doc_id and ``spans``, an array of kind number (see ``KINDS``), start and end, by start and then kind."""
    scanned = written(scan(documents), "secrets")
    return scanned.select("doc_id", _spans(scanned, thresholds(scanned)).alias("spans"))


def span_list(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def secret_digest(found: DataFrame) -> DataFrame:
    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(span_list(F.filter("spans", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    )


def mask_secrets(documents: DataFrame) -> DataFrame:
    """The documents, all columns, with each found span (overlapping ones as one) replaced by its kind in brackets.

    Texts are scanned once: rows and what was found in them are written together and read again.
    """
    scanned = written(_scan(documents.select(F.struct("*").alias("__row"), whole_text().alias("__text")), ["__row"]), "secrets")
    spanned = scanned.select("__row", _spans(scanned, thresholds(scanned)).alias("__spans"))
    masked = _masked(F.col("__row.text"), F.col("__spans"))
    text = F.when(F.size("__spans") > 0, masked).otherwise(F.col("__row.text"))
    return spanned.select(*[text.alias("text") if c == "text" else F.col("__row")[c].alias(c) for c in documents.columns])


def _masked(text: Column, spans: Column) -> Column:
    """The text with its spans, in order, replaced. Cutting starts from the front of a text, hence from pieces of it."""
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])

    def outer(ordered: Column) -> Column:
        return _let(_running(F.transform(ordered, lambda s: s["end"]), F.greatest), lambda reach: joined(ordered, reach))

    def joined(ordered: Column, reach: Column) -> Column:
        before = F.slice(F.concat(F.array(F.lit(0)), reach), F.lit(1), F.size(ordered))
        cuts = F.zip_with(ordered, before, lambda s, end: F.struct(end.alias("from"), s["start"].alias("to"), s["kind"].alias("kind")))
        kept = F.transform(_stretches(F.filter(cuts, lambda c: c["to"] >= c["from"])), of_stretch)
        return F.concat(F.array_join(kept, ""), F.substr(text, F.element_at(reach, -1) + 1, F.char_length(text)))

    def of_stretch(cuts: Column) -> Column:
        begin = cuts[0]["from"]
        piece = F.substr(text, begin + 1, F.element_at(cuts, -1)["to"] - begin)
        return _let(piece, lambda p: F.array_join(F.transform(cuts, lambda c: F.concat(
            F.substr(p, c["from"] - begin + 1, c["to"] - c["from"]), F.element_at(names, c["kind"] + 1)
        )), ""))

    return _let(spans, outer)
