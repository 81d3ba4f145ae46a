"""Importance resampling against a plain version of its contract."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from meadowlark.llm import importance
from tests.llm.conftest import SCHEMA, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text, longest=1):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, longest=1):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(map(bucket, plain_features(x, longest)[1]))
    for x in target:
        t.update(map(bucket, plain_features(x, longest)[1]))
    all_s, all_t = sum(s.values()), sum(t.values())
    out, scored = {}, []
    for i, x in docs:
        words, found = plain_features(x, longest)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in map(bucket, found)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out[i] = [len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
        if len(words) >= 20:
            scored.append((-out[i][2], i is None, i or 0, i))
    for rank, (*_, i) in enumerate(sorted(scored, key=lambda x: x[:3])[: 10 * len(scored) // 100], 1):
        out[i][3] = rank
    return {k: tuple(v) for k, v in out.items()}


@given(st.lists(st.binary(max_size=1200), max_size=12))
@settings(max_examples=60, deadline=None)
def test_crc_matrices(words):
    words = [w for w in words if w]
    assert importance.crcs(words).tolist() == [zlib.crc32(w) for w in words]


@given(st.lists(st.text(max_size=60) | st.none(), max_size=6), st.integers(1, 3))
@settings(max_examples=60, deadline=None)
def test_features(texts, longest):
    found, words, counts = importance.features_of(texts, longest, at_once=16)
    want = [plain_features(t, longest) for t in texts]
    assert words.tolist() == [len(w) for w, _ in want] and counts.tolist() == [len(f) for _, f in want]
    ends = [0, *counts.cumsum().tolist()]
    for i, (_, f) in enumerate(want):
        assert Counter(found[ends[i] : ends[i + 1]].tolist()) == Counter(zlib.crc32(x.encode()) % 10000 for x in f)


def test_equals_plain_version(spark):
    rng = random.Random(5)
    docs = [(i, prose(i, rng.randint(0, 60))) for i in range(300)] + [(300, None), (301, ""), (302, "É1 x-Y " * 20), (303, "wordless !!! ..."), (304, "z" * 3000 + " a" * 30), (305, prose(9, 30000)), (None, prose(7, 50))]
    target = [prose(1000 + i, 40) for i in range(12)] + [None, "É1 x y"]
    df = spark.createDataFrame([(i, t, "xx", "s", 0) for i, t in docs], SCHEMA).repartition(5)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    for longest in (1, 2):
        got = {r.doc_id: (r.n_features, r.weight, r.score, r.rank) for r in importance.resample(df, bench, longest=longest).collect()}
        assert got == plain(docs, target, longest)


def test_repeats_and_empty_tables(spark):
    same = spark.createDataFrame([(5, prose(1, 30), "xx", "s", 0)] * 40 + [(6, prose(2, 30), "xx", "s", 0)], SCHEMA)
    bench = spark.createDataFrame([(prose(2, 30),)], "text string")
    got = importance.resample(same, bench).collect()
    assert len(got) == 41 and sorted(r.rank for r in got if r.rank) == [1, 2, 3, 4]
    none = same.limit(0)
    assert importance.resample(none, bench).count() == 0
    left = importance.resample(same, bench.limit(0))
    assert left.where("rank is not null").count() == 4
    few = importance.resample(same.where("doc_id = 6"), bench).collect()  # a tenth of one is none
    assert [r.rank for r in few] == [None]
    odd = same.withColumn("rank", same.n_chars).withColumn("weight", same.n_chars)
    kept = importance.drawn_documents(odd, importance.resample(odd, bench))
    assert set(kept.columns) == {*odd.columns} and kept.select("rank").distinct().count() == 2
