"""Topics that the corpus itself teaches: hashed term weights and spherical k-means, in DataFrame functions.

A text's words (runs of letters and digits, lower-case) are counted in ``BUCKETS`` buckets by CRC-32. A bucket's
weight is the square root of its share of the text's words, less the mean weight of the texts of the
same language: topics then tell texts of one language apart, not the languages. The vectors are scaled to equal
length and rounded to whole numbers, so that sums over all texts are exact and every run learns the same.

Centroids begin at texts that lie far apart among a few chosen by hash, and move while one more round over all
texts gains more than ``LEAST_GAIN`` of the summed closeness. That sum is bounded, so the rounds end. Only
rows of sums, one a topic, and the first candidates, ``SEEDS`` a topic, pass the driver. A text's topic is
that of the closest centroid, of equally close ones the first.

Null texts and those without a letter or digit have the topic ``NONE`` and teach nothing. A null language is
one of its own; a text whose language has no other words at all has no direction and takes the first topic.
Equal texts in one language have equal topics; repeated rows count as often as they come. A very long text is held
as an array of its words and a character for each. Empty tables teach no topic. Input columns named as a result column or
as one of the vectors' own (``_counts``, ``_weights``, ``_unit`` and so on) give way.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meadowlark.functions.arrays import bound
from meadowlark.llm.common import col, staged, without

#: A power of two, at most 64: each bucket has an ASCII character, from this one on.
BUCKETS, FIRST = 64, 48
TOPICS = 8
NONE = "none"
#: Whole numbers stand for parts of this.
SCALE = 1024
LEAST_GAIN = 1e-2
#: Candidates a topic for the first centroids.
SEEDS = 16
#: Mean weights are broadcast if there are at most so many languages (some 600 bytes each).
LANGS_TO_SEND = 20_000


@dataclass
class Model:
    """Mean weights by language (``_lang``, ``_mean``) and the centroids, vectors of length one."""

    means: DataFrame
    centroids: list[list[float]]


def featured(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` with ``_counts``, the number of words in each bucket."""
    keep = [col(c) for c in without(docs, ["_counts"])]
    words = F.split(F.lower(F.coalesce(col(text), F.lit(""))), r"[^\p{L}\p{N}]+")
    letter = F.transform(words, lambda w: F.when(w == "", "").otherwise(F.char(F.crc32(w).bitwiseAND(F.lit(BUCKETS - 1)) + FIRST)))

    def counts(s: Column) -> Column:  # of a string that has a letter a word
        return F.array(*[(F.octet_length(s) - F.octet_length(F.replace(s, F.lit(chr(FIRST + b)), F.lit("")))) for b in range(BUCKETS)])

    return docs.select(*keep, bound(F.array_join(letter, ""), counts).alias("_counts"))


def weighted(rows: DataFrame, lang: str) -> DataFrame:
    """``featured`` rows with the language as a key, ``_all`` words, and ``_weights`` in place of the counts."""
    keep = [col(c) for c in without(rows, ["_counts", "_weights", "_all", "_lang"])]
    key = F.coalesce(F.concat(F.lit("="), col(lang).cast("string")), F.lit("null")) if lang in rows.columns else F.lit("null")
    total = F.aggregate("_counts", F.lit(0).cast("long"), lambda s, x: s + x)
    # bound, as the optimizer would put the sum into the loop over the buckets
    weights = bound(F.greatest(total, F.lit(1)), lambda n: F.transform("_counts", lambda x: F.floor(F.sqrt(x / n) * SCALE).cast("int")))
    return rows.select(*keep, "_counts", key.alias("_lang")).select(*keep, "_lang", total.alias("_all"), weights.alias("_weights"))


def directed(rows: DataFrame, means: DataFrame, lang: str) -> DataFrame:
    """``featured`` rows with ``_all`` words and ``_unit``, a vector of equal length, in place of the counts."""
    keep = [col(c) for c in without(rows, ["_counts", "_weights", "_all", "_lang", "_mean", "_unit"])]
    side = F.broadcast(means) if means.count() <= LANGS_TO_SEND else means
    both = weighted(rows, lang).join(side, "_lang", "left").withColumn("_mean", F.coalesce("_mean", F.array_repeat(F.lit(0.0), BUCKETS)))
    off = F.zip_with("_weights", "_mean", lambda x, m: x - F.coalesce(m, F.lit(0.0)))

    def scaled(v: Column) -> Column:
        by = F.coalesce(F.try_divide(F.lit(float(SCALE)), F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))), F.lit(0.0))
        return bound(by, lambda f: F.transform(v, lambda x: F.rint(x * f).cast("int")))

    return both.select(*keep, "_all", bound(off, scaled).alias("_unit"))


def dot(vector: list[float], at: int = 0) -> str:
    """SQL of ``_unit`` times a fixed vector, as a balanced sum."""
    if len(vector) == 1:
        return f"_unit[{at}] * {vector[0]!r}D"
    half = len(vector) // 2
    return f"({dot(vector[:half], at)} + {dot(vector[half:], at + half)})"


def closest(vectors: DataFrame, centroids: list[list[float]]) -> DataFrame:
    """Adds ``_topic``, the closest centroid's place from 0, and ``_close``, a whole number."""
    keep = [col(c) for c in without(vectors, ["_scores", "_topic", "_close"])]
    scored = vectors.select(*keep, F.expr(f"array({', '.join(map(dot, centroids))})").alias("_scores"))
    best = F.array_max("_scores")
    return scored.select(*keep, (F.array_position("_scores", best) - 1).alias("_topic"), F.round(best * SCALE).cast("long").alias("_close"))


def unit(vector: list[float]) -> list[float]:
    size = sum(x * x for x in vector) ** 0.5
    return [x / size for x in vector] if size else [0.0] * len(vector)


def first_centroids(vectors: DataFrame, k: int) -> list[list[float]]:
    """Of the vectors with the least hash in each of ``SEEDS * k`` classes the one with the least hash of all,
    then always the one whose closest centroid is farthest; fewer than ``k`` if there are no more."""
    hashed = vectors.withColumn("_hash", F.xxhash64("_unit"))
    least = [r.h for r in hashed.groupBy(F.pmod("_hash", F.lit(SEEDS * k))).agg(F.min("_hash").alias("h")).collect()]
    rows = hashed.where(F.col("_hash").isin(least)).groupBy("_hash").agg(F.first("_unit").alias("unit")).collect()
    free = [unit(r.unit) for r in sorted(rows, key=lambda r: r["_hash"])]
    nearest, out = [-2.0] * len(free), []
    while free and len(out) < k:
        at = min(range(len(free)), key=nearest.__getitem__)
        if nearest[at] > 1 - 1e-9:
            break
        out.append(free[at])
        nearest = [max(n, sum(x * y for x, y in zip(v, free[at]))) for n, v in zip(nearest, free)]
    return out


def learn(rows: DataFrame, k: int = TOPICS, *, lang: str = "lang") -> Model:
    """The model of ``featured`` rows, which are read once a round and had better be staged."""
    known = weighted(rows, lang).where("_all > 0")
    mean = F.array(*[F.sum(F.col("_weights")[b]) / F.count("*") for b in range(BUCKETS)])
    means = staged(known.groupBy("_lang").agg(mean.alias("_mean")), "means")
    vectors = staged(directed(rows, means, lang).where("_all > 0").select("_unit"), "vectors")
    centroids, before = first_centroids(vectors, k), None
    while centroids:
        now = closest(vectors, centroids).groupBy("_topic").agg(F.sum("_close").alias("close"), F.array(*[F.sum(F.col("_unit")[b]) for b in range(BUCKETS)]).alias("unit")).collect()  # a row a topic
        close = sum(r.close for r in now)
        if before is not None and close - before <= LEAST_GAIN * abs(before):
            break
        before = close
        moved = {r["_topic"]: unit(r.unit) for r in now}
        centroids = [moved[i] if any(moved.get(i, ())) else c for i, c in enumerate(centroids)]
    return Model(means, centroids)


def assign(rows: DataFrame, model: Model, *, lang: str = "lang") -> DataFrame:
    """``featured`` rows with ``topic`` in place of the counts."""
    keep = [col(c) for c in without(rows, ["_counts", "_weights", "_all", "_lang", "_mean", "_unit", "_scores", "_topic", "_close", "topic"])]
    if not model.centroids:
        return rows.select(*keep, F.lit(NONE).alias("topic"))
    found = closest(directed(rows, model.means, lang), model.centroids)
    return found.select(*keep, F.when(F.col("_all") > 0, F.concat(F.lit("topic"), F.col("_topic"))).otherwise(NONE).alias("topic"))


def with_topics(docs: DataFrame, k: int = TOPICS, *, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with a learned ``topic``. They are staged with their counts, which are made once; learning reads only those."""
    counted = staged(featured(docs, text=text), "features")
    return assign(counted, learn(counted, k, lang=lang), lang=lang)
