"""Mixing sources to target weights: iterative proportional fitting within bounds.

Token counts are summed by (source, language, topic) cell, and each dimension's values get targets: shares
that the caller states, or the values' own token counts to a power, times the token budget. A value can't
give more tokens than it has, so a target beyond that is clamped and the others of its dimension take over
what is left. The cells' weights are then raked: scaled to each dimension's targets in turn. A cell is
never taken more than whole: a weight counts at most as much as the cell's tokens, and what full cells
can't give is raked from the others. Weight against tokens is the probability with which each of a cell's
documents is sampled, by a hash of its id, so that the expected tokens meet every marginal.

Raking goes on while its worst deviation shrinks by a tenth or more over ``BLOCK`` rounds. If it stalls
above ``CLOSE`` (targets that no weights meet together, each of them reachable alone) a warning says by how
much; the last dimension's targets come first then. ``margins`` reports each value's tokens, target,
whether it was clamped, and the expected tokens.

Topics are the caller's, or learned from the texts (``topics``), as in the queries.

Only DataFrame functions are used. The loop works on cells, not on documents; its windows hold the
cells of one value (of a language: sources x topics, some 100 bytes each, which Spark spills if it must).

Nulls: a null source, language or topic is a value of its own; a null or empty text has no tokens
and, like all of its cell, its cell's probability (a cell without tokens: the overall rate).
Documents with equal ids meet the same fate; repeated rows count as often as they come. Texts are read
whole and passed over by expressions, a very long one like any other. An empty table gives an empty one.
Columns of the input that have the name of a result column give way.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meadowlark.llm import topics
from meadowlark.llm.common import col, staged, without

DIMENSIONS = ("source", "lang", "topic")
#: Unless shares are stated, targets go as a value's tokens to this power: 1 keeps them, 0 makes them even.
TEMPER = {"source": 0.5, "lang": 0.3, "topic": 0.7}
RATE = 0.5
#: Rounds of raking between two looks at the deviation, which counts as none below this part of the budget.
BLOCK, CLOSE = 6, 1e-6
#: Cells are broadcast to the documents if there are at most so many (about 100 bytes each).
CELLS_TO_SEND = 200_000
#: Cells of a raking task, and tasks at least: a block deals the cells out 18 times, and each task that does so leaves
#: files of a disk block or more, however few its cells.
CELLS_A_TASK, LEAST_TASKS = 2_000, 4


def form_of(text: Column) -> Column:
    """A text's form: table, marked-up, shouted, note, article or book; for callers that mix by form, not by topic."""
    t = F.coalesce(text, F.lit(""))
    n = F.length(t)
    return (
        F.when(t.contains(" | "), "table")
        .when(t.rlike(r"[#$%&*]{3}"), "markup")
        .when(t.contains("!! "), "shout")
        .when(n < 500, "note")
        .when(n < 5000, "article")
        .otherwise("book")
    )


def topic_of(text: Column, terms: dict[str, dict[str, float]], other: str = "other") -> Column:
    """The topic whose weighted terms (topic -> lower-case word -> weight) add up to most over the text's
    words; of equals the first by name, ``other`` if none occurs."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    known = sorted({w for weights in terms.values() for w in weights})
    names = sorted(terms)
    weights = F.create_map(*[x for w in known for x in (F.lit(w), F.array(*[F.lit(float(terms[t].get(w, 0))) for t in names]))])
    hits = F.filter(F.transform(words, lambda w: F.try_element_at(weights, w)), lambda x: x.isNotNull())
    none = F.array(*[F.lit(0.0) for _ in names])
    sums = F.aggregate(hits, none, lambda s, x: F.zip_with(s, x, lambda a, b: a + b))
    best = F.array_position(sums, F.array_max(sums))
    return F.when(F.array_max(sums) > 0, F.element_at(F.array(*map(F.lit, names)), best.cast("int"))).otherwise(other)


def tokens_of(text: Column) -> Column:
    """Runs of characters that aren't white space."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")).cast("long")


def value_of(value: Column) -> Column:
    """A dimension's value as a key of its cells: null is one too, and unlike the text "null"."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("null"))


def by_dimension(of: dict[str, Column]) -> Column:
    return reduce(lambda c, d: c.when(F.col("dimension") == d, of[d]), DIMENSIONS[1:], F.when(F.col("dimension") == DIMENSIONS[0], of[DIMENSIONS[0]]))


def targets(cells: DataFrame, rate: float, powers: dict[str, float], shares: dict[str, dict[str | None, float]]) -> DataFrame:
    """(dimension, value, tokens, clamped, target): what each value should give in all."""
    each = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in DIMENSIONS]))
    values = cells.select(each.alias("x"), "tokens").groupBy("x.dimension", "x.value").agg(F.sum("tokens").alias("tokens"))

    def goal(d: str) -> Column:
        if d not in shares:
            return F.pow("tokens", F.lit(powers[d]))
        stated = {"null" if v is None else f"={v}": float(s) for v, s in shares[d].items()}
        return reduce(lambda c, v: F.when(F.col("value") == v, stated[v]).otherwise(c), stated, F.lit(0.0))

    values = staged(values.withColumn("goal", F.when(F.col("tokens") > 0, by_dimension({d: goal(d) for d in DIMENSIONS})).otherwise(0.0)), "values")
    scale, full = dict.fromkeys(DIMENSIONS, 0.0), None
    while True:  # each pass settles which values are taken whole; the scale only grows, at most one pass a value
        scales = by_dimension({d: F.lit(s) for d, s in scale.items()})
        whole = (F.col("goal") > 0) & (scales * F.col("goal") >= F.col("tokens"))
        now = values.groupBy("dimension").agg(
            F.sum("tokens").alias("all"), F.sum(F.when(whole, F.col("tokens")).otherwise(0)).alias("whole"), F.sum(F.when(whole, 0.0).otherwise(F.col("goal"))).alias("rest"), F.count(F.when(whole, 1)).alias("n")
        ).collect()  # a row a dimension
        if {r["dimension"]: r["n"] for r in now} == full:
            break
        full = {r["dimension"]: r["n"] for r in now}
        scale |= {r["dimension"]: max(scale[r["dimension"]], (rate * r["all"] - r["whole"]) / r["rest"]) for r in now if r["rest"]}
    return values.select("dimension", "value", "tokens", whole.alias("clamped"), F.when(whole, F.col("tokens").cast("double")).otherwise(scales * F.col("goal")).alias("target"))


def taken() -> Column:
    """The expected tokens of a cell."""
    return F.least(F.col("w"), F.col("tokens").cast("double"))


def rake(cells: DataFrame, rate: float) -> DataFrame:
    """Adds ``w`` to cells with ``tokens`` and ``target_*``: of it counts ``least(w, tokens)``, whose sums by
    each dimension are the targets within ``CLOSE`` of the budget, where some weights can do that."""
    tasks = max(LEAST_TASKS, -(-cells.count() // CELLS_A_TASK))
    out = cells.withColumn("w", F.col("tokens") * F.lit(float(rate))).coalesce(tasks)
    before = None
    while True:
        for _ in range(BLOCK):
            for d in DIMENSIONS:
                w, own, target = Window.partitionBy(d), F.col("tokens").cast("double"), F.col(f"target_{d}")
                full = F.col("w") >= own
                held, free = F.sum(F.when(full, own).otherwise(0.0)).over(w), F.sum(F.when(full, 0.0).otherwise(F.col("w"))).over(w)
                by = F.when((free > 0) & (target > held), (target - held) / free).otherwise(F.coalesce(F.try_divide(target, held + free), F.lit(1.0)))
                out = out.withColumn("w", F.least(F.col("w") * by, own * 1e6)).coalesce(tasks)
        out = staged(out, "rake")
        worst = deviation(out, rate)
        if worst < CLOSE:
            return out
        if before is not None and worst > 0.9 * before:
            warnings.warn(f"the targets can't all be met together: one is missed by {worst:.4f} of the token budget", stacklevel=2)
            return out
        before = worst


def deviation(cells: DataFrame, rate: float) -> float:
    """By how much of the token budget the worst target is missed."""
    off = [cells.groupBy(d).agg((F.sum(taken()) - F.first(f"target_{d}")).alias("off")).select(F.abs("off").alias("off")) for d in DIMENSIONS]
    worst = reduce(DataFrame.unionAll, off).agg(F.max("off")).first()[0] or 0.0
    return worst / max((cells.agg(F.sum("tokens")).first()[0] or 0) * rate, 1.0)


def counted(docs: DataFrame, topic: Column | str, *, text: str = "text") -> DataFrame:
    """``docs`` with ``topic`` (an expression, or the name of a column), ``n_tokens`` and each row's cell."""
    keep = without(docs, ["topic", "n_tokens", "prob", "sampled", *[f"cell_{d}" for d in DIMENSIONS]])
    value = {d: col(d) if d in keep else F.lit(None).cast("string") for d in ("source", "lang")}
    value["topic"] = col(topic) if isinstance(topic, str) else topic
    return docs.select(*map(col, keep), value["topic"].alias("topic"), tokens_of(col(text)).alias("n_tokens"), *[value_of(c).alias(f"cell_{d}") for d, c in value.items()])


def fitted(rows: DataFrame, rate: float = RATE, powers: dict[str, float] | None = None, shares: dict[str, dict[str | None, float]] | None = None) -> DataFrame:
    """The raked cells of ``counted`` rows: source, lang, topic, tokens, ``target_*``, ``clamped_*``, w, prob."""
    cells = staged(rows.groupBy(*[F.col(f"cell_{d}").alias(d) for d in DIMENSIONS]).agg(F.sum("n_tokens").alias("tokens")), "cells")
    goals = targets(cells, rate, TEMPER | (powers or {}), shares or {})
    for d in DIMENSIONS:
        cells = cells.join(goals.where(F.col("dimension") == d).select(F.col("value").alias(d), F.col("target").alias(f"target_{d}"), F.col("clamped").alias(f"clamped_{d}")), d)
    out = rake(staged(cells, "cells"), rate)
    return out.withColumn("prob", F.coalesce(F.least(F.lit(1.0), F.try_divide("w", "tokens")), F.lit(float(rate))))


def margins(cells: DataFrame) -> DataFrame:
    """(dimension, value, tokens, target, clamped, expected) of ``fitted`` cells: a target is clamped if the
    value has fewer tokens than its share asks for; expected are the tokens that sampling takes."""
    per = [
        cells.groupBy(F.lit(d).alias("dimension"), F.col(d).alias("value")).agg(F.sum("tokens").alias("tokens"), F.first(f"target_{d}").alias("target"), F.first(f"clamped_{d}").alias("clamped"), F.sum(taken()).alias("expected"))
        for d in DIMENSIONS
    ]
    return reduce(DataFrame.unionAll, per)


def sampled(rows: DataFrame, cells: DataFrame, *, doc_id: str = "doc_id", seed: int = 5) -> DataFrame:
    """``counted`` rows with ``prob`` and ``sampled``."""
    names = [f"cell_{d}" for d in DIMENSIONS]
    side = cells.select(*[F.col(d).alias(f"cell_{d}") for d in DIMENSIONS], "prob")
    if cells.count() <= CELLS_TO_SEND:
        side = F.broadcast(side)
    uniform = F.pmod(F.xxhash64(col(doc_id).cast("string"), F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    return rows.join(side, names).withColumn("sampled", uniform < F.col("prob")).drop(*names)


def mix(
    docs: DataFrame,
    topic: Column | str | None = None,
    rate: float = RATE,
    powers: dict[str, float] | None = None,
    shares: dict[str, dict[str | None, float]] | None = None,
    *,
    text: str = "text",
    doc_id: str = "doc_id",
    seed: int = 5,
) -> DataFrame:
    """Adds ``topic``, ``n_tokens``, ``prob`` and ``sampled`` to all documents. Without ``topic`` the topics are
    learned (``topics``), and the documents staged with them. ``shares`` states target
    shares (dimension -> value -> share, values that aren't named get none); else ``powers`` tempers a
    dimension's own token counts."""
    if topic is None:
        docs, topic = topics.with_topics(docs, text=text), "topic"
    rows = counted(docs, topic, text=text)
    return sampled(rows, fitted(rows, rate, powers, shares), doc_id=doc_id, seed=seed)


def mixing_digest(docs: DataFrame) -> DataFrame:
    """The query's columns: every document's cell, tokens, probability and whether it is sampled."""
    rows = counted(docs.select("doc_id", "source", "lang", "text"), F.lit(None).cast("string"))
    slim = staged(topics.featured(rows).drop("text", "topic", "cell_topic"), "counted")
    mixed = staged(topics.assign(slim, topics.learn(slim)).withColumn("cell_topic", value_of(F.col("topic"))), "mixed")
    return sampled(mixed, fitted(mixed))
