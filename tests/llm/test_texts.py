"""Personal data, decontamination, languages, mixing, against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from meadowlark.llm import decontaminate, lang_id, mixing, pii

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), k, kind, m.end()))
    return [f"{kind}:{s}:{e}" for s, _, kind, e in sorted(out)]


def test_base_spans(spark):
    rng = random.Random(2)
    parts = ["a@b.co", "x.y_z%+-@d-e.f.g", "@", "..", ".", "1.2.3.4", "300.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 1234-567", "+1", "ü", "😀", " ", "-", "7", "00012", "a@b", "q@r.s..t@u.v", "\n", "5500 0000 0000 0004", "12 "]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 14)))) for i in range(1500)]
    rows += [(9000, None), (9001, ""), (9002, "1" * 30000), (9003, "1 " * 20000), (9004, "a@b" + ".c" * 20000), (9005, "a" * 50000), (9006, "+1" + "2" * 40000), (9007, "a@b.c " * 500)]
    got = {r.doc_id: r for r in pii.pii_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        want = base_spans(t or "")
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (t or "")[:80]
        assert [x for x in got[i].spans.split(",") if x and x.split(":")[0] in BASE] == want
        assert got[i].n_email == sum(x.startswith("email") for x in want)


def test_added_kinds_scores_and_mask(spark):
    rows = [(1, "IBAN DE89 3704 0044 0532 0130 00 ok"), (2, "DE89370400440532013001"), (3, "ssn 123-45-6789"), (4, "123-45-6789"), (5, "mail a@b.co and a@b.co"), (6, None), (7, "")]
    df = pii.find_pii(spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, pii string"))
    got = {r.doc_id: [(x.kind, x.value, x.score) for x in r.pii] for r in df.collect()}
    assert got[1] == [("iban", "DE89 3704 0044 0532 0130 00", 0.9)] and got[2] == []
    assert got[3] == [("ssn", "123-45-6789", 0.6)] and got[4] == [] and got[6] == got[7] == []
    hidden = {r.doc_id: r.text for r in pii.masked(df).collect()}
    assert hidden[5] == "mail [EMAIL] and [EMAIL]" and hidden[4] == "123-45-6789" and hidden[6] is None and hidden[7] == ""
    assert pii.find_pii(df.drop("pii").limit(0)).count() == 0


def test_account_numbers_with_neighbours(spark):
    de, gb, no, odd = "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "NO93 8601 1117 947", "ZZ92 ABCD 1234 5678 90"
    rows = [
        (f"IBAN: {de} BIC: COBADEFFXXX", [de]),
        (f"{de.replace(' ', '')} BIC COBADEFF", [de.replace(" ", "")]),
        (f"{de} EUR 250", [de]),
        (f"{gb} 2024-01-03", [gb]),
        (f"ü😀 {de} {gb} {no} {de}", [de, gb, no, de]),
        (f"AB12 {de} X", [de]),
        (f"DE00 1111 {de}", [de]),
        (f"{odd} EUR 250", [odd]),
        (f"{de}x {gb}_ {de[:-1]} {de}9", []),
        ("AB12 " * 3000 + de, [de]),
    ]
    df = pii.find_pii(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "doc_id long, text string"))
    got = {r.doc_id: [(x.value, x.start, x.end) for x in r.pii if x.kind == "iban"] for r in df.collect()}
    for i, (t, want) in enumerate(rows):
        assert [v for v, _, _ in got[i]] == want and all(t[s:e] == v for v, s, e in got[i]), t[:80]
    hidden = {r.doc_id: r.text for r in pii.masked(df).collect()}
    assert hidden[0] == "IBAN: [IBAN] BIC: COBADEFFXXX" and hidden[4] == "ü😀 [IBAN] [IBAN] [IBAN] [IBAN]"


def near(text, start, end):
    return (text[max(0, start - pii.NEAR) : start] + "\n" + text[end : end + pii.NEAR]).lower()


def test_context_and_mask_of_many_matches(spark, monkeypatch):
    """Scores from the signs around each span, and the masked text, against plain Python; chunks and pieces are
    so small that every text has many."""
    monkeypatch.setattr(pii, "CHUNK", 3)
    monkeypatch.setattr(pii, "PIECE", 7)
    rng = random.Random(9)
    parts = ["a@b.co", " mail ", "1.2.3.4", ".5", "host ", "4111 1111 1111 1111", " visa ", "+49 (30) 1234-567", "é😀", " ", "\n", "7", "123-45-6789", " ssn ", "GB82WEST12345698765432", " iban ", "x" * 60]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 40)))) for i in range(300)] + [(1000, " ".join(f"host 10.0.{i % 300}.7" for i in range(400)))]
    found = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"))
    got, hidden = ({r.doc_id: r for r in df.collect()} for df in (found, pii.masked(found)))
    for i, t in rows:
        assert [f"{x.kind}:{x.start}:{x.end}" for x in got[i].pii if x.kind in BASE] == base_spans(t)
        for x in got[i].pii:
            assert t[x.start : x.end] == x.value
            gain = pii.GAIN if re.search(pii.CONTEXT[x.kind], near(t, x.start, x.end)) else 0
            assert abs(x.score - pii.SCORE[x.kind] - gain) < 1e-9
        out, at = "", 0
        for x in got[i].pii:
            if x.start >= at:
                out += t[at : x.start] + f"[{x.kind.upper()}]"
            at = max(at, x.end)
        assert hidden[i].text == out + t[at:]


def test_a_text_of_very_many_matches(spark):
    n = 20000
    text = " ".join(f"host 10.0.{i % 256}.7" for i in range(n))
    got = pii.masked(pii.find_pii(spark.createDataFrame([(1, text)], "doc_id long, text string"))).first()
    assert len(got.pii) == n and got.text == " ".join(["host [IP]"] * n)


def edit(p, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p):
        new = [i + 1]
        for j, x in enumerate(t):
            new.append(min(row[j] + (c != x), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_leaks(spark, monkeypatch):
    from tests.llm.conftest import prose

    rng = random.Random(4)
    items = [(i, prose(100 + i, rng.randint(8, 30))) for i in range(12)] + [(50, None), (51, " "), (None, "lost"), (3, prose(500, 12))]
    docs = []
    for i in range(60):
        t = list(prose(300 + i, 30))
        if i % 2:
            x = list(rng.choice(items[:12])[1])
            for _ in range(rng.randint(0, int(len(x) * 0.1))):
                at = rng.randrange(len(x))
                x[at : at + rng.randint(0, 1)] = rng.choice(["", "q", "zz"])
            t[50:50] = [" ", *"".join(x).upper(), "\n"]
        docs.append((i, "".join(t)))
    docs += [(100, None), (101, ""), (102, prose(7, 20000)), (102, prose(7, 20000))]
    d = spark.createDataFrame([(*r, "clash") for r in docs], "doc_id long, text string, leaks string")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for i, t in dict(docs).items():
        n = decontaminate.normal(t)
        if len(n) > 3000:
            continue
        for k, x in items:
            x = decontaminate.normal(x)
            if k is not None and x and n and (e := edit(x, n)) <= int(len(x) * decontaminate.RATE):
                want[i, k] = min(e, want.get((i, k), 99))
    for block, held in ((decontaminate.BLOCK, decontaminate.HELD), (400, decontaminate.HELD), (40, 1)):
        monkeypatch.setattr(decontaminate, "HELD", held)
        marked = decontaminate.mark(d, b, block=block)
        assert marked.count() == len(docs)
        assert {(r.doc_id, x.item_id): x.distance for r in marked.collect() for x in r.leaks} == want
    assert len(want) > 10
    monkeypatch.setattr(decontaminate, "KEPT", 1000)  # two or three of the blocks stay
    assert {(r.doc_id, x.item_id): x.distance for r in decontaminate.mark(d, b, block=400).collect() for x in r.leaks} == want
    kept = {r.doc_id for r in decontaminate.decontaminate(d, b).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _ in want}
    assert decontaminate.mark(d, b.limit(0)).where("size(leaks) > 0").count() == 0 and decontaminate.mark(d.limit(0), b).count() == 0


def test_distance_by_bits():
    rng = random.Random(1)
    for _ in range(500):
        p, t = ("".join(rng.choices("ab c", k=rng.randint(1, n))) for n in (70, 90))
        assert decontaminate.distance_within(p, t, 99) == edit(p, t)


def sentences(seed, lang, n):
    rng = random.Random(seed)
    syllables = {"aa": ["ka", "to", "mi", "ru"], "bb": ["sch", "ein", "ung", "ver"], "cc": ["eau", "tion", "que", "elle"]}[lang]
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n))


def test_languages(spark):
    rows = [(i, sentences(i, lang, 40), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 40)]
    rows += [(200, None, "aa"), (201, "", None), (202, "123 !!", None), (203, sentences(7, "aa", 60) + " " + sentences(8, "bb", 60), None), (204, sentences(9, "cc", 9000), None), (205, "kato", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in lang_id.language_digest(df).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got.values())
    held = [i for i, _, x in rows if x and i < 200 and got[i].held_out]
    assert held and all(got[i].lang_pred == rows[i][2] for i in held)
    import zlib

    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _, _ in rows)
    assert [got[i].lang_pred for i in (200, 201, 202)] == ["und"] * 3 and got[204].lang_pred == "cc" and got[205].lang_pred == "aa"
    parts = dict(x.split(":") for x in got[203].langs.split(","))
    assert set(parts) == {"aa", "bb"} and 0.3 < float(parts["aa"]) < 0.7


def mixed_text(model, shares, n, seed):
    """Counts of n trigrams drawn from languages by their shares."""
    rng = np.random.default_rng(seed)
    return sum(rng.multinomial(int(n * s), model[i] / model[i].sum()) for i, s in shares.items()).astype(np.float32)


def relatives(seed, near, far):
    """Trigram models of ``near`` languages that share most of their trigrams, and of ``far`` ones that share none."""
    rng = np.random.default_rng(seed)
    common, models = rng.random(1500) ** 4, []
    for i in range(near + far):
        m = np.full(lang_id.BUCKETS, 0.01)
        if i < near:
            m[:1500] += 100 * common * rng.uniform(0.2, 1.8, 1500)
            m[1500 + 60 * i : 1560 + 60 * i] += 20
        else:
            m[5000 + 400 * (i - near) : 5400 + 400 * (i - near)] += 100 * rng.random(400)
        models.append(m / m.sum())
    return np.array(models, np.float32)


def test_second_language_behind_relatives():
    model = relatives(3, 10, 2)
    counts = np.array([mixed_text(model, {0: 0.8, 11: 0.2}, 1500, 1), mixed_text(model, {0: 1.0}, 1500, 2), mixed_text(model, {10: 1.0}, 40, 3)])
    got = lang_id.choose(counts, model.astype(np.float32))
    assert [set(np.flatnonzero(g >= 0.005)) for g in got] == [{0, 11}, {0}, {10}]
    assert abs(got[0][11] - 0.2) < 0.03


def test_any_number_of_languages():
    model = relatives(4, 1, 6)
    wanted = [{1: 0.25, 2: 0.25, 3: 0.25, 4: 0.25}, {i: 1 / 7 for i in range(7)}, {1: 0.7, 2: 0.1, 3: 0.1, 4: 0.05, 6: 0.05}]
    got = lang_id.choose(np.array([mixed_text(model, w, 3000, i) for i, w in enumerate(wanted)]), model)
    for g, w in zip(got, wanted, strict=True):
        assert {i for i in range(7) if g[i] >= 0.005} == set(w) and all(abs(g[i] - s) < 0.02 for i, s in w.items())


def test_choice_of_languages_is_the_best_set():
    """Against all sets of five languages, three of them related; in pieces as in one go."""
    from itertools import combinations

    model, rng = relatives(5, 3, 2), np.random.default_rng(6)
    counts = np.array([mixed_text(model, dict(enumerate(rng.dirichlet(np.full(5, 0.4)))), int(rng.integers(20, 2000)), i) + np.eye(1, lang_id.BUCKETS, 7, dtype=np.float32)[0] for i in range(60)])

    def best(c):
        at = np.flatnonzero(c)
        n, p, found = c[at].astype(float), model[:, at].astype(float), []
        for k in range(1, 6):
            for among in combinations(range(5), k):
                s = np.full(k, 1 / k)
                for _ in range(200):
                    s = s * (p[list(among)] @ (n / (s @ p[list(among)]))) / n.sum()
                found.append((n @ np.log(s @ p[list(among)]) / 3 - (k - 1) * np.log(max(n.sum() / 3, 2)) / 2, among))
        return max(found)

    got = lang_id.choose(counts.copy(), model)
    near = 0
    for c, g in zip(counts, got, strict=True):
        among = best(c)[1]
        near += set(np.flatnonzero(g >= 0.005)) == set(among)
    assert near == len(counts)
    lang_id_pieces = lang_id.AT_ONCE
    try:
        lang_id.AT_ONCE = 1000
        assert np.allclose(lang_id.choose(counts.copy(), model), got, atol=1e-4)
    finally:
        lang_id.AT_ONCE = lang_id_pieces


def test_slow_fits_go_on(monkeypatch):
    """A round at a time or many, the same sets: no number of tries ends a fit."""
    model = relatives(5, 4, 2)
    rng = np.random.default_rng(9)
    counts = np.array([mixed_text(model, dict(enumerate(rng.dirichlet(np.full(6, 0.5)))), int(rng.integers(200, 6000)), i) + np.eye(1, lang_id.BUCKETS, 7, dtype=np.float32)[0] for i in range(30)])
    want = lang_id.choose(counts.copy(), model)
    monkeypatch.setattr(lang_id, "ROUNDS", 1)
    got = lang_id.choose(counts.copy(), model)
    assert [set(np.flatnonzero(g >= 0.01)) for g in got] == [set(np.flatnonzero(g >= 0.01)) for g in want]
    same = np.repeat(model[:1], 3, axis=0)  # languages that can't be told apart
    assert (lang_id.choose(counts.copy(), same) > 0).sum(1).tolist() == [1] * 30


def test_fit_tells_languages_from_noise(spark):
    rng = random.Random(3)
    rows = [(i, sentences(i, lang, 40), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 40)]
    noise = ["".join(rng.choices("qwxzjyp ", k=400)), "ж" * 300, "中文字" * 80]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, model = lang_id.train(df)
    more = df.unionByName(spark.createDataFrame([(1000 + i, t, None) for i, t in enumerate(noise)], df.schema))
    got = {r.doc_id: r for r in lang_id.identify(more, langs, model).collect()}
    assert all(got[i].fit > 1 for i, _, _ in rows) and all(got[1000 + i].fit < 0 for i in range(len(noise)))
    t, at = rows[0][1], langs.index("aa")
    counts = lang_id.trigram_counts([t])[0]
    bits = sum(n * np.log2(model[at][b] * lang_id.BUCKETS) for b, n in enumerate(counts) if n) / counts.sum()
    assert got[0].langs.startswith("aa:1") and abs(got[0].fit - bits) < 1e-3


def test_languages_without_training(spark):
    df = spark.createDataFrame([(1, "abc", None), (2, None, None)], "doc_id long, text string, lang string")
    langs, model = lang_id.train(df)
    assert {r.lang_pred for r in lang_id.identify(df, langs, model).collect()} == {"und"}
    assert lang_id.identify(df.limit(0), langs, model).count() == 0


def test_language_limit(spark, monkeypatch):
    monkeypatch.setattr(lang_id, "MAX_LANGS", 1)
    with pytest.raises(ValueError):
        lang_id.train(spark.createDataFrame([("a", "x"), ("b", "y")], "text string, lang string"))


def goals(cells, rate, d, goal):
    """Brute force: a dimension's targets, clamped to what its values have."""
    have = {}
    for c, t in cells.items():
        have[c[d]] = have.get(c[d], 0) + t
    want = {v: goal(v, t) if t else 0.0 for v, t in have.items()}
    low, high = 0.0, 1e9
    for _ in range(200):
        mid = (low + high) / 2
        spent = sum(min(have[v], mid * want[v]) for v in have)
        low, high = (mid, high) if spent < rate * sum(have.values()) else (low, mid)
    return {v: min(have[v], low * want[v]) for v in have}


def raked(cells, targets, rate, rounds=300):
    """Brute force: raking where a value's factor is found by halving, and cells stay within their tokens."""
    w = {c: rate * t for c, t in cells.items()}
    for _ in range(rounds):
        for d, target in enumerate(targets):
            for v, goal in target.items():
                mine = [c for c in cells if c[d] == v]
                low, high = -60.0, 60.0
                for _ in range(60):
                    mid = (low + high) / 2
                    low, high = (mid, high) if sum(min(cells[c], 2**mid * w[c]) for c in mine) < goal else (low, mid)
                for c in mine:
                    w[c] = min(2**low * w[c], 64.0 * cells[c])
    return {c: min(x, cells[c]) for c, x in w.items()}


def expected(got):
    """Tokens by cell, and those that sampling is expected to take, by (dimension, value)."""
    cells, out = {}, {}
    for r in got:
        key = (r.source, r.lang, r.topic)
        cells[key] = cells.get(key, 0) + r.n_tokens
        for d, v in enumerate(key):
            out[d, v] = out.get((d, v), 0) + r.n_tokens * r.prob
    return cells, out


def scarce(n):
    rng = random.Random(6)
    words = lambda: " ".join(["w"] * rng.choice([0, 3, 50, 700])) + (" | " if rng.random() < 0.05 else "")
    return [(i, words(), rng.choice(["en", "en", "en", "en", "en", "de", None]), rng.choice(["s1", "s1", "s2", "s3"])) for i in range(n)]


def test_mixing(spark):
    df = spark.createDataFrame(scarce(4000), "doc_id long, text string, lang string, source string")
    form = mixing.form_of(F.col("text"))
    counted = mixing.counted(df, form)
    fit = mixing.fitted(counted)
    got = mixing.sampled(counted, fit).collect()
    assert len(got) == 4000 and all(r.n_tokens == len(r.text.split()) for r in got)
    cells, took = expected(got)
    total = sum(cells.values())
    targets = [goals(cells, mixing.RATE, d, lambda v, t, name=name: t ** mixing.TEMPER[name]) for d, name in enumerate(mixing.DIMENSIONS)]
    for d, target in enumerate(targets):
        for v, goal in target.items():
            assert abs(took[d, v] - goal) < 1e-5 * total, (d, v)
    assert any(goal and abs(goal - sum(t for c, t in cells.items() if c[d] == v)) < 1e-6 * total for d, target in enumerate(targets) for v, goal in target.items())  # some are clamped
    whole = raked(cells, targets, mixing.RATE, 40)
    for r in got:
        key = (r.source, r.lang, r.topic)
        assert abs(r.prob - (whole[key] / cells[key] if cells[key] else mixing.RATE)) < 1e-3
    assert abs(sum(r.n_tokens for r in got if r.sampled) / total - mixing.RATE) < 0.05
    assert {r.doc_id: r.sampled for r in mixing.sampled(counted.repartition(3), fit).collect()} == {r.doc_id: r.sampled for r in got}
    told = {(r.dimension, r.value): r for r in mixing.margins(fit).collect()}
    for d, name in enumerate(mixing.DIMENSIONS):
        for v, goal in targets[d].items():
            r = told[name, "null" if v is None else f"={v}"]
            assert abs(r.expected - took[d, v]) < 1e-4 * total and abs(r.target - goal) < 1e-4 * total
            assert r.clamped == (goal > 0 and r.target >= r.tokens)


def test_stated_shares(spark):
    df = spark.createDataFrame(scarce(3000), "doc_id long, text string, lang string, source string")
    shares = {"lang": {"en": 3, "de": 1}, "source": {"s1": 1, "s2": 1, "s3": 1}}
    cells, took = expected(mixing.mix(df, mixing.form_of(F.col("text")), 0.1, {"topic": 1.0}, shares).collect())
    total = 0.1 * sum(cells.values())
    assert abs(took[1, "en"] / total - 0.75) < 1e-4 and abs(took[1, "de"] / total - 0.25) < 1e-4 and took[1, None] == 0
    assert all(abs(took[0, s] / total - 1 / 3) < 1e-4 for s in ("s1", "s2", "s3"))


def test_targets_that_cant_hold_together(spark):
    rows = [(i, "w " * 10, "en" if i % 2 else "de", "s1" if i % 2 else "s2", "t") for i in range(200)]  # a language a source
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, about string")
    with pytest.warns(UserWarning, match="together"):
        cells = mixing.fitted(mixing.counted(df, "about"), 0.2, shares={"lang": {"en": 0.9, "de": 0.1}, "source": {"s1": 0.5, "s2": 0.5}})
    told = {(r.dimension, r.value): r for r in mixing.margins(cells).collect()}
    assert abs(told["topic", "=t"].expected - 400) < 1 and not any(r.clamped for r in told.values())


def test_topics_by_terms(spark):
    terms = {"law": {"court": 2.0, "appeal": 1.0}, "food": {"soup": 1.0, "court": 0.5}}
    rows = [("The COURT, the soup!", "law"), ("soup soup soup court", "food"), ("nothing", "none"), (None, "none"), ("", "none"), ("appeal soup", "food")]
    df = spark.createDataFrame(rows, "text string, want string").withColumn("got", mixing.topic_of(F.col("text"), terms, "none"))
    assert all(r.got == r.want for r in df.collect())


def test_mixing_edges(spark):
    df = spark.createDataFrame([(None, None, None, None, "x"), (1, "", "en", "s", "x"), (1, "a b", "en", "s", "x"), (1, "a b", "en", "s", "x")], "doc_id long, text string, lang string, source string, prob string")
    form = mixing.form_of(F.col("text"))
    got = mixing.mix(df, form).collect()
    assert len(got) == 4 and all(0 <= r.prob <= 1 for r in got)
    assert len({r.sampled for r in got if r.n_tokens == 2}) == 1
    assert mixing.mix(df.limit(0), form).count() == 0
    only = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert mixing.mix(only, F.lit("t")).first().topic == "t"
