"""Near duplicates and repeated passages against brute force."""

from collections import Counter, defaultdict

import numpy as np
import pytest

from meadowlark.llm import ngram_join, suffix_dedup
from tests.llm.conftest import prose


def texts(df):
    return [(r.doc_id, tuple((r.text or "").split())) for r in df.select("doc_id", "text").collect()]


def linked(rows):
    """Brute force: (doc_id -> (copy_of, class_id, n_links))."""
    rep = {}
    for i, w in rows:
        if i is not None and w:
            rep[w] = min(i, rep.get(w, i))
    sets = {r: {w[k : k + 5] for k in range(max(1, len(w) - 4))} for w, r in rep.items()}
    ids = sorted(sets)
    links, root = Counter(), {i: i for i in ids}
    for a in ids:
        for b in ids:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                low, high = sorted((root[a], root[b]))
                root = {i: low if x == high else x for i, x in root.items()}
    return {i: (rep[w], root[rep[w]], links[rep[w]]) if w else (i, i, 0) for i, w in rows if i is not None}


@pytest.mark.parametrize("tile", [256, 3])
def test_links_and_classes(corpus, monkeypatch, tile):
    monkeypatch.setattr(ngram_join, "TILE", tile)
    got = ngram_join.near_duplicates(corpus).collect()
    assert len(got) == corpus.count()
    assert {r.doc_id: (r.copy_of, r.class_id, r.n_links) for r in got if r.doc_id is not None} == linked(texts(corpus))
    assert [(r.copy_of, r.class_id, r.n_links) for r in got if r.doc_id is None] == [(3, 3, 0)]  # a copy of 3
    assert sum(r.doc_id == 12 for r in got) == 2


@pytest.fixture(scope="module")
def shared_ids(spark):
    """Ids that two texts share, rows that come twice, rows without an id, texts without words."""
    a, b, c = (prose(i, 100) for i in (501, 502, 503))
    near = lambda t, k: " ".join(t.split()[:-k] + ["new"] * k)
    rows = [(1, a), (1, b), (2, near(a, 2)), (3, near(b, 3)), (3, near(b, 3)), (4, c), (4, c), (4, c), (None, c), (None, near(a, 1)), (None, "lone words"), (None, "lone words"), (5, ""), (5, ""), (6, None), (None, None)]
    return spark.createDataFrame([(*r, f"s{i % 2}") for i, r in enumerate(rows)], "doc_id long, text string, source string")


def test_shared_and_missing_ids(shared_ids):
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.class_id if r.class_id is not None else -1, r.n_links) for r in ngram_join.near_duplicates(shared_ids).collect())
    want = [(1, 1, 2), (1, 1, 1), (2, 1, 2), (3, 1, 1), (3, 1, 1), (4, 4, 0), (4, 4, 0), (4, 4, 0), (-1, 4, 0), (-1, 1, 2), (-1, -1, 0), (-1, -1, 0), (5, 5, 0), (5, 5, 0), (6, 6, 0), (-1, -1, 0)]
    assert got == sorted(want)


def test_one_of_each_class_stays(spark, shared_ids):
    kept = [(r.doc_id, r.text) for r in ngram_join.one_of_each(shared_ids).collect()]
    a, b, c = (prose(i, 100) for i in (501, 502, 503))
    assert Counter(kept) == Counter([(1, a), (1, b), (4, c), (None, "lone words"), (5, ""), (5, ""), (6, None), (None, None)])
    again = ngram_join.one_of_each(shared_ids.repartition(3))
    assert sorted(again.collect(), key=repr) == sorted(ngram_join.one_of_each(shared_ids).collect(), key=repr)
    assert ngram_join.one_of_each(shared_ids.limit(0)).count() == 0


def test_large_class_of_near_copies(spark, monkeypatch):
    """Blocks by members and by words give the same links as one tile."""
    base = prose(900, 150).split()
    rows = [(i, " ".join(base[: 10 + i % 130] + [f"u{i}"] + base[11 + i % 130 :])) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = linked(texts(df))
    for tile, words in ((512, 10**6), (7, 10**6), (512, 900)):
        monkeypatch.setattr(ngram_join, "TILE", tile)
        monkeypatch.setattr(ngram_join, "WORDS", words)
        assert {r.doc_id: (r.copy_of, r.class_id, r.n_links) for r in ngram_join.near_duplicates(df).collect()} == want


def test_no_documents_and_other_columns(spark, corpus):
    assert ngram_join.near_duplicates(corpus.limit(0)).count() == 0
    odd = corpus.where("doc_id < 3").selectExpr("doc_id as id", "text as body", "lang as rep", "source as digest", "n_chars as key", "1 as doc_id")
    assert sorted(r.doc_id for r in ngram_join.near_duplicates(odd, "body", "id").collect()) == [0, 1, 2]


def test_pruning_keeps_likely_pairs():
    assert ngram_join.needed(20) < 0.8 * 20 and ngram_join.needed(120) > 0.5 * 120
    values = np.random.default_rng(0).integers(0, 2**32, (3, ngram_join.VALUES)).astype(np.uint32)
    values[1] = values[0]
    values[1, 7:12] += 1
    left, right = ngram_join.likely(values[:, ngram_join.ROWS :], np.array([0, 0, 1]), np.array([1, 2, 2]))
    assert list(zip(left, right)) == [(0, 1)]
    block, codes = np.zeros(3, np.int32), ngram_join.band_codes(values)
    assert (codes[0] == codes[1]).sum() == ngram_join.BANDS - 2  # 7 to 11 lie in bands 1 and 2
    pairs = lambda band: [(i, j) for part in ngram_join.pairs_of(block, 0, 0, codes[:, :band]) for i, j in zip(*part)]
    assert pairs(0) == [(0, 1), (0, 2), (1, 2)]
    assert pairs(3) == [(0, 2), (1, 2)]  # band 0 has the other already


@pytest.mark.parametrize("n", [3, 60])
def test_overlaps_equal_set_intersections(n):
    rng = np.random.default_rng(n)
    common = rng.integers(0, 2**63, 50, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(common, 30), rng.integers(0, 2**63, 5, dtype=np.uint64)])) for _ in range(n)]
    left, right = np.triu_indices(n, 1)
    want = [len(set(sets[i].tolist()) & set(sets[j].tolist())) for i, j in zip(left, right)]
    assert ngram_join.overlaps(sets, left, right).tolist() == want
    assert ngram_join.overlaps(sets, left[:1], right[:1]).tolist() == want[:1]


def test_classes_join_over_tiles(spark):
    stars = spark.createDataFrame([(i + 1, i, 1) for i in range(30)] + [(100, 100, 1)], "node long, root long, links long")
    assert {r.node: r.label for r in ngram_join.connected(stars).collect()} == {i: 0 for i in range(31)} | {100: 100}


def passages(rows):
    """Brute force: stretches of 50-word windows that texts of two documents have. A document is an id."""
    ids, where = defaultdict(set), defaultdict(set)
    for i, w in rows:
        if i is not None and len(w) >= 50:
            ids[w].add(i)
    for w, own in ids.items():
        for s in range(len(w) - 49):
            where[w[s : s + 50]] |= own
    out = set()
    for w, own in ids.items():
        if len(own) > 1:
            out |= {(i, 0, len(w)) for i in own}
            continue
        spans = []
        for s in range(len(w) - 49):
            if len(where[w[s : s + 50]]) > 1:
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = s + 50
                else:
                    spans.append([s, s + 50])
        out |= {(i, a, b) for i in own for a, b in spans}
    return sorted(out)


@pytest.mark.parametrize("run", [256, 2])
def test_passages_of_repeated_rows_and_shared_ids(spark, monkeypatch, run):
    monkeypatch.setattr(suffix_dedup, "RUN", run)
    a, b, c, d = (prose(i, 120) for i in (801, 802, 803, 804))
    part = lambda t, i, j: " ".join(t.split()[i:j])
    rows = [(5, a), (5, a), (5, a)]  # one document, however often
    rows += [(6, b + " " + prose(900, 20)), (6, prose(901, 30) + " " + b)]  # two texts of one document
    rows += [(7, c), (7, "  " + c.replace(" ", "\n")), (7, part(c, 0, 60) + " " + prose(902, 60)), (8, part(c, 30, 90) + " " + prose(903, 9)), (8, part(c, 30, 90) + " " + prose(903, 9))]
    rows += [(9, d), (10, d), (9, d), (9, part(d, 10, 80) + " x"), (None, a), (None, b)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.start, r.stop) for r in suffix_dedup.repeated_passages(df).collect())
    assert got == passages(texts(df))
    assert got == [(7, 30, 90), (8, 0, 60), (9, 0, 70), (9, 0, 120), (10, 0, 120)]


@pytest.mark.parametrize("run", [256, 2])
def test_passages(corpus, monkeypatch, run):
    monkeypatch.setattr(suffix_dedup, "RUN", run)
    got = sorted((r.doc_id, r.start, r.stop) for r in suffix_dedup.repeated_passages(corpus).collect())
    assert got == passages(texts(corpus))
    assert not any(i == 81 for i, _, _ in got)  # repeats within one document don't count


@pytest.mark.parametrize("run", [256, 1])
def test_windows_that_neighbours_miss(spark, monkeypatch, run):
    """Texts that share a passage around one anchor, hidden among texts that share only one side of it."""
    monkeypatch.setattr(suffix_dedup, "RUN", run)
    left, right = prose(1, 27).split(), prose(2, 60).split()
    rows = [(0, prose(10, 30).split() + left + right[:30] + prose(11, 30).split()), (1, prose(12, 30).split() + left + right[:30] + prose(13, 30).split())]
    rows += [(2 + i, prose(20 + i, 40).split() + right + prose(40 + i, 20).split()) for i in range(9)]
    rows += [(20 + i, prose(60 + i, 40).split() + left[5:] + right[:25] + prose(80 + i, 30).split()) for i in range(9)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    assert sorted((r.doc_id, r.start, r.stop) for r in suffix_dedup.repeated_passages(df).collect()) == passages(texts(df))


def test_cut_and_empty(spark, corpus):
    assert suffix_dedup.repeated_passages(corpus.limit(0)).count() == 0
    spans = spark.createDataFrame([(1, 1, 3)], "doc_id long, start long, stop long")
    docs = spark.createDataFrame([(1, "a b\nc d"), (2, "x  y"), (3, None)], "doc_id long, text string")
    assert {r.doc_id: r.text for r in suffix_dedup.cut_passages(docs, spans).collect()} == {1: "a d", 2: "x  y", 3: None}
