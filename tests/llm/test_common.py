"""Word hashes, sorted runs, clashing names."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from meadowlark.llm import chat_format, common, ngram_join, suffix_dedup

pieces = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t \u3000😀x", max_size=40)), max_size=6)


@settings(max_examples=200, deadline=None)
@given(pieces, st.integers(1, 12))
def test_words_hash_alike_in_pieces(texts, size):
    hashes, ends = common.word_hashes(texts)
    words = [w for t in texts for w in (t or "").split()]
    assert [int(n) for n in np.diff(ends)] == [len((t or "").split()) for t in texts] and len(hashes) == len(words)
    assert len(set(hashes.tolist())) == len(set(words)) == len(set(zip(words, hashes.tolist())))
    with pytest.MonkeyPatch.context() as m:
        m.setattr(common, "_AT_ONCE", size)
        again, same = common.word_hashes(texts)
    assert (again == hashes).all() and (same == ends).all()


def test_long_words_differ_by_place():
    a, _ = common.word_hashes(["x" * 600 + "y", "y" + "x" * 600, "x" * 601])
    assert len(set(a.tolist())) == 3


@settings(max_examples=200, deadline=None)
@given(pieces)
def test_shingles_are_sets_of_words(texts):
    grams, starts = ngram_join.shingles(*common.word_hashes(texts))
    words = [tuple((t or "").split()) for t in texts]
    want = [{w[i : i + 5] for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    assert [len(set(grams[a:b].tolist())) for a, b in zip(starts[:-1], starts[1:])] == [len(x) for x in want]
    seen = {}
    for a, b, w in zip(starts[:-1], starts[1:], words):
        for i, g in enumerate(grams[a:b].tolist()):
            assert seen.setdefault(w[i : i + 5], g) == g


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=30), st.integers(1, 8))
def test_runs_stay_whole(keys, step):
    keys.sort()
    rows = pa.record_batch([pa.array(keys, pa.int64()), pa.array(range(len(keys)), pa.int64())], ["k", "v"])
    got = list(common.sorted_runs((rows.slice(i, step) for i in range(0, len(keys), step)), ["k"]))
    assert [v for t in got for v in t.column("v").to_pylist()] == list(range(len(keys)))
    seen = [set(t.column("k").to_pylist()) for t in got]
    assert all(not (a & b) for i, a in enumerate(seen) for b in seen[:i])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=60), st.integers(1, 12))
def test_sliding_minimum(xs, width):
    got = suffix_dedup.sliding_min(np.array(xs), width)
    assert all(got[i] == min(xs[i : i + width]) for i in range(len(xs) - width + 1))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="\\#/<>turn :\nax", max_size=60))
def test_escapes_are_undone(text):
    assert chat_format.unescape(chat_format.escape(text)) == text
    assert chat_format.unescape_role(chat_format.escape_role(text)) == text


def test_clashing_columns_give_way(spark):
    df = spark.createDataFrame([("a", 1, None)], "`x.y` string, N int, text string")
    out = common.add_by_rows(df, ["text"], [T.StructField("n", T.LongType())], lambda t: [[len(x or "") for x in t]])
    assert out.columns == ["x.y", "text", "n"] and out.first().n == 0
