"""Personal data: regular expressions propose spans, checksums confirm them, context adjusts.

Everything is built from DataFrame functions. Java's regular expressions cut a text into what lies
between the matches (``split``) and the matches themselves (``regexp_extract_all``); running sums of
their lengths in code points give each match's place. Repeated groups are possessive, which here
matches the same strings as the greedy form but in a loop, so that very long runs of digits or dots
can't overflow the stack. Context comes from the matches and gaps around a match, and masking cuts the
text into pieces of bounded length first, so that a very long text with very many matches takes time in
proportion: what a loop gathers, it gathers by chunks of ``CHUNK``.

Kinds, in order: ``email``, ``ip`` (parts at most 255), ``card`` (12 to 19 digits, Luhn), ``phone``
(9 to 15 digits); these base spans always stay. The method adds ``iban`` (mod-97) and ``ssn``; they
stay if their score, raised by context words up to 48 characters before or after, reaches 0.5.
What follows an account number often reads on like it ("BIC", "EUR 250", another one), so an ``iban``
may start at each place where the pattern can, and ends where its country's length does, or after the
whole run; a country whose length isn't known ends after any group of the run, the longest that passes.

Nulls: a null text counts as empty and has no spans; ``masked`` keeps it null. Rows are handled one
by one, so repeated rows, ties and empty tables need no rule; spans of several kinds may overlap.
Columns of the input that have the name of a result column give way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meadowlark.functions.arrays import bound, states
from meadowlark.llm.common import col, without

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
#: Fixed patterns. A lookbehind that keeps a search from starting inside a run it has failed on
#: doesn't change what is found.
PATTERN = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
}
#: Where an account number may start, and (as a group) the rest of its run and the sign after it.
IBAN = r"\b[A-Z]{2}[0-9]{2}(?=((?:\x20?[A-Z0-9]){11,30}[\s\S]?))"
#: Signs of an account number by country.
IBAN_LENGTHS = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}
CONTEXT = {
    "email": r"e-?mail|contact|write to|@",
    "ip": r"\bip\b|address|host|server",
    "card": r"card|visa|credit|payment|debit",
    "phone": r"phone|tel\b|call|mobile|fax",
    "iban": r"iban|account|bank|konto|compte|cuenta",
    "ssn": r"ssn|social security|national id",
}
#: Of a confirmed match, before context.
SCORE = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.5, "iban": 0.7, "ssn": 0.4}
NEAR, GAIN, LEAST = 48, 0.2, 0.5
CHUNK, PIECE = 64, 512
#: So many matches and gaps before or after a match have NEAR characters or all there are: a match has four at least.
PARTS = 2 * NEAR // 4
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether up to 20 digits pass Luhn's check: every second one from the right counts doubled."""
    padded = F.lpad(number, 20, "0")
    doubled = F.translate(padded, "0123456789", "0246813579")
    total = F.aggregate(F.sequence(F.lit(1), F.lit(20)), F.lit(0), lambda s, i: s + F.substring(F.when(i % 2 == 1, doubled).otherwise(padded), i, F.lit(1)).cast("int"))
    return total % 10 == 0


def mod97(value: Column) -> Column:
    """Whether an account number has the remainder 1 by 97 once its first four signs stand last."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))
    step = lambda rest, c: F.when(c.between("0", "9"), rest * 10 + F.ascii(c) - 48).otherwise(rest * 100 + F.ascii(c) - 55) % 97
    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step) == 1


def confirmed(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")
    if kind == "card":
        d = digits(value)
        return F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(digits(value)).between(9, 15)
    if kind == "iban":
        return F.length(F.replace(value, F.lit(" "), F.lit(""))).between(15, 34) & mod97(value)
    if kind == "ssn":
        return ~value.rlike("^(000|666|9)|-00-|-0000$")
    return F.lit(True)


def matches(gaps: Column, values: Column) -> Column:
    """The places of the matches ``values`` between ``gaps``: start, end (exclusive) in code points, value."""
    sizes = F.transform(values, lambda v, i: F.struct(F.length(F.get(gaps, i)).alias("gap"), F.length(v).alias("own"), v.alias("value")))

    def placed(given: Column) -> Column:
        before = states(F.transform(given, lambda x: x["gap"] + x["own"]), lambda at, x: at + x, F.lit(0), chunk=CHUNK)
        return F.zip_with(given, before, lambda x, at: F.struct((at + x["gap"]).alias("start"), (at + x["gap"] + x["own"]).alias("end"), x["value"].alias("value")))

    return bound(sizes, placed)


def cut(text: Column, pattern: str) -> Column:
    """What lies between a pattern's leftmost non-overlapping matches, and these."""
    return F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values"))


def account_numbers(text: Column) -> Column:
    """Confirmed account numbers that don't overlap: start, end (exclusive) in code points, value."""
    heads = bound(cut(text, IBAN), lambda c: F.arrays_zip(matches(c["gaps"], c["values"]).alias("head"), F.regexp_extract_all(text, F.lit(IBAN), F.lit(1)).alias("rest")))
    length = F.create_map(*[F.lit(x) for n, codes in IBAN_LENGTHS.items() for c in codes.split() for x in (c, n)])

    def value(x: Column) -> Column:
        run = F.concat(x["head"]["value"], x["rest"])
        known = F.try_element_at(length, F.substring(run, 1, 2))
        ends = {n: F.regexp_extract(run, rf"^[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}\b", 0) for n in range(34, 14, -1)}
        longest = F.regexp_extract(run, r"^[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}\b", 0)
        own = F.array(F.coalesce(*[F.when(known == n, end) for n, end in ends.items()], F.lit("")), longest)
        passing = F.filter(F.when(known.isNull(), F.array(*ends.values())).otherwise(own), lambda v: (v != "") & confirmed("iban", v))
        return F.struct(x["head"]["start"].alias("start"), F.try_element_at(passing, F.lit(1)).alias("value"))

    def first_ones(found: Column) -> Column:
        before = states(F.transform(found, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))), lambda at, x: F.when(x["start"] >= at, x["end"]).otherwise(at), F.lit(0), chunk=CHUNK)
        marked = F.zip_with(found, before, lambda x, at: F.struct(x.alias("span"), (x["start"] >= at).alias("fresh")))
        return F.transform(F.filter(marked, lambda x: x["fresh"]), lambda x: x["span"])

    valued = F.filter(F.transform(heads, value), lambda x: x["value"].isNotNull())
    return bound(F.transform(valued, lambda x: F.struct(x["start"].alias("start"), (x["start"] + F.length(x["value"])).alias("end"), x["value"].alias("value"))), first_ones)


def parts(gaps: Column, values: Column) -> Column:
    """Gap, match, gap, match, ... gap."""
    pairs = F.transform(gaps, lambda g, i: F.array(g, F.coalesce(F.get(values, i), F.lit(""))))
    return F.flatten(pairs)


def around(gaps: Column, values: Column, use: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """``use(near)`` where ``near(i)`` is the text up to ``NEAR`` characters before and after match i (lower
    case), made of the ends of the gaps and matches around it."""
    heads = lambda p: F.transform(p, lambda x: F.left(x, F.lit(NEAR)))
    tails = lambda p: F.transform(p, lambda x: F.right(x, F.lit(NEAR)))

    def with_ends(e: Column) -> Column:
        def near(i: Column) -> Column:
            own = 2 * i + 2  # the match's place among the parts
            first = F.greatest(own - 1 - PARTS, F.lit(1))
            before = F.right(F.array_join(F.slice(e["tails"], first, own - first), ""), F.lit(NEAR))
            after = F.left(F.array_join(F.slice(e["heads"], own + 1, F.lit(PARTS + 1)), ""), F.lit(NEAR))
            return F.lower(F.concat(before, F.lit("\n"), after))

        return use(near)

    return bound(bound(parts(gaps, values), lambda p: F.struct(heads(p).alias("heads"), tails(p).alias("tails"))), with_ends)


def scored(kind: str, span: Column, near: Column) -> Column:
    score = F.lit(SCORE[kind]) + F.when(near.rlike(CONTEXT[kind]), F.lit(GAIN)).otherwise(F.lit(0.0))
    return F.struct(span["start"].alias("start"), F.lit(KINDS.index(kind)).alias("order"), F.lit(kind).alias("kind"), span["end"].alias("end"), F.round(score, 2).alias("score"), span["value"].alias("value"))


def between(text: Column, spans: Column) -> Column:
    """Gaps and values of spans that are in order and don't overlap, as ``cut`` gives them for a pattern."""
    ends = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(spans, lambda x: x["end"]))
    starts = F.concat(F.transform(spans, lambda x: x["start"]), F.array(F.length(text).cast("bigint")))
    stretches = F.arrays_zip(ends.alias("a"), starts.alias("b"))
    gaps = bound(pieces(text), lambda p: F.transform(stretches, lambda x: stretch(p, x["a"], x["b"])))
    return F.struct(gaps.alias("gaps"), F.transform(spans, lambda x: x["value"]).alias("values"))


def pieces(text: Column) -> Column:
    """The text in pieces of ``PIECE`` code points."""
    return F.regexp_extract_all(text, F.lit(rf"[\s\S]{{1,{PIECE}}}"), F.lit(0))


def stretch(cells: Column, a: Column, b: Column) -> Column:
    """The text from code point ``a`` to ``b`` (exclusive), from its pieces."""
    first = F.floor(a / PIECE).cast("int")
    whole = F.array_join(F.slice(cells, first + 1, F.floor(b / PIECE).cast("int") - first + 1), "")
    return F.when(b > a, F.substring(whole, (a - first * PIECE + 1).cast("int"), (b - a).cast("int"))).otherwise("")


def find_pii(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``pii``: an array of (start, order, kind, end, score, value) by start, then kind."""
    t = F.coalesce(col(text), F.lit(""))

    def spans_of(kind: str) -> Column:
        def found(c: Column) -> Column:
            placed = F.transform(c["spans"], lambda x, i: F.struct(x.alias("span"), i.alias("i")))
            kept = placed if kind == "iban" else F.filter(placed, lambda x: confirmed(kind, x["span"]["value"]))
            score = lambda k: around(c["gaps"], c["values"], lambda near: F.transform(k, lambda x: scored(kind, x["span"], near(x["i"]))))
            return bound(kept, lambda k: F.when(F.size(k) > 0, score(k)))

        if kind == "iban":
            all_found = bound(account_numbers(t), lambda s: bound(between(t, s), lambda c: F.struct(c["gaps"], c["values"], s.alias("spans"))))
        else:
            all_found = bound(cut(t, PATTERN[kind]), lambda c: F.struct(c["gaps"], c["values"], matches(c["gaps"], c["values"]).alias("spans")))
        spans = bound(all_found, found)
        some = t.contains("@") if kind == "email" else t.contains("+") if kind == "phone" else t.rlike(PATTERN[kind])
        return F.when(some, spans if kind in BASE else F.filter(spans, lambda x: x["score"] >= LEAST))

    found = [spans_of(kind) for kind in KINDS]
    none = F.expr("cast(array() as array<struct<start: bigint, order: int, kind: string, end: bigint, score: double, value: string>>)")
    whole = F.sort_array(F.concat(*[F.coalesce(x, none) for x in found]))
    return df.select(*map(col, without(df, ["pii"])), whole.alias("pii"))


def masked(df: DataFrame, text: str = "text", spans: str = "pii") -> DataFrame:
    """Replaces the text's spans by ``[KIND]``; where spans overlap, the one that starts first counts."""
    t = col(text)
    end = F.length(t).cast("bigint")
    items = F.concat(F.transform(col(spans), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")).alias("tag"))), F.array(F.struct(end.alias("start"), end.alias("end"), F.lit("").alias("tag"))))

    def rebuilt(cells: Column) -> Column:
        def put(given: Column) -> Column:
            before = states(F.transform(given, lambda x: x["end"]), lambda at, x: F.greatest(at, x), F.lit(0), chunk=CHUNK)
            return F.array_join(F.zip_with(given, before, lambda x, at: F.when(x["start"] >= at, F.concat(stretch(cells, at, x["start"]), x["tag"])).otherwise("")), "")

        return bound(items, put)

    return df.withColumn(text, F.when(F.size(col(spans)) > 0, bound(pieces(t), rebuilt)).otherwise(t))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def pii_digest(docs: DataFrame) -> DataFrame:
    """The query's columns."""
    found = find_pii(docs.select("doc_id", "text")).drop("text")
    count = lambda kind: F.size(F.filter("pii", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("pii", lambda x: x["order"] < len(BASE))
    return found.select("doc_id", *map(count, KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("pii")).alias("spans"), F.array_join(F.transform("pii", lambda x: x["score"].cast("string")), ",").alias("scores"))
