"""Learned topics against a brute force of their own, and against topics that are planted."""

import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from meadowlark.llm import mixing, topics
from meadowlark.llm.common import staged
from tests.llm.test_texts import expected, goals

SCHEMA = "doc_id long, text string, lang string, source string"


def planted(n, seed=4):
    """Texts of two languages with common words, and words of one of three topics in each."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang, about = rng.choice(["aa", "bb", None]), rng.randrange(3)
        common, own = [f"{lang}{j}" for j in range(30)], [f"{lang}about{about}x{j}" for j in range(12)]
        words = rng.choices(common, k=rng.randint(40, 120)) + rng.choices(own, k=60)
        rng.shuffle(words)
        out.append((i, ", ".join(words).title(), lang, "s", about))
    return out


def vectors(rows):
    """Brute force: whole vectors of equal length by text, those without words left out."""
    counts, langs = [], []
    for _, text, lang, *_ in rows:
        words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
        if words:
            counts.append(np.bincount([zlib.crc32(w.encode()) % topics.BUCKETS for w in words], minlength=topics.BUCKETS))
            langs.append(lang)
    weights = [np.floor(np.sqrt(c / c.sum()) * topics.SCALE) for c in counts]
    means = {g: np.mean([w for w, x in zip(weights, langs) if x == g], 0) for g in set(langs)}
    off = [w - means[g] for w, g in zip(weights, langs)]
    return np.array([np.round(o / np.linalg.norm(o) * topics.SCALE) if o.any() else o for o in off])


def test_topics_match_brute_force_and_planted_ones(spark):
    rows = planted(400)
    docs = spark.createDataFrame([r[:4] for r in rows], SCHEMA).repartition(5)
    feats = staged(topics.featured(docs).drop("text"), "features")
    model = topics.learn(feats, 3)
    got = {r.doc_id: r.topic for r in topics.assign(feats, model).collect()}
    units = vectors(rows)
    made = topics.directed(feats, model.means, "lang").orderBy("doc_id").collect()
    made = [r["_unit"] for r in made]
    assert np.abs(np.array(made) - units).max() <= 1  # a half may be rounded either way
    scores = np.array(made) @ np.array(model.centroids).T
    assert [got[i] for i in range(400)] == [f"topic{k}" for k in scores.argmax(1)]
    for k in range(3):  # one more round moves nothing far
        mean = np.array(made)[scores.argmax(1) == k].sum(0)
        assert mean @ np.array(model.centroids[k]) / np.linalg.norm(mean) > 0.99
    # words differ by language, so a planted topic is told within each language
    pure = 0
    for lang in {r[2] for r in rows}:
        mine = [r for r in rows if r[2] == lang]
        for about in range(3):
            found = [got[r[0]] for r in mine if r[4] == about]
            pure += max(found.count(t) for t in set(found))
    assert pure > 0.9 * len(rows)


def test_topics_do_not_depend_on_partitions_or_order(spark):
    docs = spark.createDataFrame([r[:4] for r in planted(150)], SCHEMA)
    once, again = (topics.learn(topics.featured(d), 4) for d in (docs.repartition(1), docs.orderBy(F.desc("doc_id")).repartition(7)))
    assert once.centroids == again.centroids and len(once.centroids) == 4


def test_topic_edges(spark):
    rows = [(1, None, "aa", "s"), (2, "", "aa", "s"), (3, " ?! ", None, "s"), (4, "alone in its language", "zz", "s"), (5, "one two", None, "s"), (5, "one two", None, "s"), (6, "word " * 50_000, None, "s"), (None, "three two", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("_unit", F.lit("x")).withColumn("topic", F.lit("mine"))
    got = topics.with_topics(docs).collect()
    assert sorted(map(repr, [(r.doc_id, r.text) for r in got])) == sorted(repr(r[:2]) for r in rows)
    assert all((r.topic == topics.NONE) == (r.doc_id in (1, 2, 3)) for r in got)
    assert len({r.topic for r in got if r.doc_id == 5}) == 1
    assert topics.with_topics(docs.limit(0)).count() == 0
    assert {r.topic for r in topics.with_topics(docs.where("doc_id <= 3")).collect()} == {topics.NONE}
    assert {r.topic for r in topics.with_topics(docs.select("text").where("text = 'one two'")).collect()} == {"topic0"}


def test_raking_tasks_follow_the_cells(spark, monkeypatch):
    """A few cells are raked by a few tasks, whatever the number of shuffle partitions."""
    tasks, real = [], mixing.staged

    def staged(df, label):
        if label == "rake":
            tasks.append(df.rdd.getNumPartitions())
        return real(df, label)

    monkeypatch.setattr(mixing, "staged", staged)
    held = {"spark.sql.shuffle.partitions": "30", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        cells = spark.range(60).selectExpr("cast(id % 5 as string) source", "cast(id % 4 as string) lang", "cast(id % 3 as string) topic", "10L tokens", "60D target_source", "75D target_lang", "100D target_topic")
        out = mixing.rake(cells, 0.5).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert tasks and max(tasks) <= 4
    assert len(out) == 60 and all(abs(r.w - 5) < 1e-6 for r in out)


def test_mixing_learns_topics(spark):
    docs = spark.createDataFrame([r[:4] for r in planted(300)], SCHEMA)
    digest = {r.doc_id: r for r in mixing.mixing_digest(docs).collect()}
    mixed = {r.doc_id: r for r in mixing.mix(docs).collect()}
    assert len({r.topic for r in mixed.values()}) == topics.TOPICS
    assert all((r.topic, r.n_tokens, r.sampled) == (mixed[i].topic, mixed[i].n_tokens, mixed[i].sampled) for i, r in digest.items())
    cells, took = expected(mixed.values())  # languages and topics may contradict each other: topics come first
    for v, goal in goals(cells, mixing.RATE, 2, lambda v, t: t ** mixing.TEMPER["topic"]).items():
        assert abs(took[2, v] - goal) < 1e-5 * sum(cells.values())
