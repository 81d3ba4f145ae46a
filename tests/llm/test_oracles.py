"""The corpus queries that SQL can express, against DuckDB; the pipeline's stages; the registry."""

import os
from pathlib import Path

import pytest

from meadowlark.llm import pipeline, queries
from meadowlark.llm.common import staged, table

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not Path(SF).exists(), reason="no tables")


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, name):
    import duckdb

    con = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from '{f}'")
    got = queries.queries()[name](spark, SF)
    columns = sorted(got.columns)
    rows = sorted((tuple(r) for r in got.select(*columns).collect()), key=repr)
    rel = con.execute(queries.oracle_sql()[name])
    names = [c[0] for c in rel.description]
    assert sorted(names) == columns
    assert rows == sorted((tuple(r[names.index(c)] for c in columns) for r in rel.fetchall()), key=repr)


@needs_tables
def test_pipeline_stages(spark):
    """Each stage drops or changes what it should, by brute force, and nothing else."""
    from tests.llm.test_copies import linked, texts
    from tests.llm.test_texts import base_spans, edit
    from meadowlark.llm.decontaminate import RATE, normal

    docs = table(spark, SF, "documents")
    kept = [docs]
    for name, stage in pipeline.STAGES:
        kept.append(staged(stage(spark, kept[-1], SF), name))
    raw, known, single, clean, masked, mixed = ({r.doc_id: r for r in df.collect()} for df in kept)
    for before, df in zip(kept, kept[1:-1]):
        assert df.columns == before.columns == pipeline.COLUMNS
    assert set(raw) - set(known) == {i for i, r in raw.items() if not any(map(str.isalpha, r.text or ""))}
    classes = linked(texts(kept[1]))
    assert set(single) == {i for i in known if classes[i][1] == i}
    items = [normal(r.text) for r in table(spark, SF, "benchmark").collect()]
    leaked = {i for i, r in single.items() if any(x in normal(r.text) for x in items)}
    assert leaked <= set(single) - set(clean)
    for i in set(single) - set(clean) - leaked:
        assert any(edit(x, normal(single[i].text)) <= int(len(x) * RATE) for x in items)
    assert set(masked) == set(clean)
    for i, r in masked.items():
        assert (r.text == clean[i].text) == (not base_spans(clean[i].text)) or "[IBAN]" in r.text or "[SSN]" in r.text
        assert base_spans(r.text) == [] and r.n_chars == len(r.text)
    assert set(mixed) <= set(masked) and mixed and all(0 < r.prob <= 1 for r in mixed.values())


def test_language_stage(spark):
    """Jumbles, unknown scripts and letterless texts go; a clear contradiction of a label counts, a short text's not."""
    from tests.llm.test_texts import sentences

    rows = [(i, sentences(i, lang, 60), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 50)]
    jumble = " ".join(sentences(900 + k, lang, 70) for k, lang in enumerate(["aa", "bb", "cc"]))
    odd = [(200, jumble, None), (201, "中文字" * 90, None), (202, "123", "aa"), (203, None, "aa"), (204, sentences(7, "bb", 80), "aa"), (205, "kato", "bb"), (206, sentences(8, "cc", 80), None), (206, sentences(8, "cc", 80), None)]
    docs = spark.createDataFrame([(*r, "s", len(r[1] or "")) for r in rows + odd], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, r.lang) for r in pipeline.identify_language(spark, docs, "").collect()]
    assert sorted(got) == [(i, lang) for i, _, lang in rows] + [(204, "bb"), (205, "bb"), (206, "cc"), (206, "cc")]


@needs_tables
def test_stages_take_nulls_repeats_and_empty_tables(spark):
    rows = [(1, "the same words in two rows", "en", "s", 1)] * 2 + [(None, None, None, None, None), (2, "", None, None, 0), (3, "w " * 60000, "en", None, 1)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, sampled string")
    for name, stage in pipeline.STAGES:
        n = stage(spark, docs, SF).count()
        assert n <= len(rows) and (name != "pii" or n == len(rows)) and (name != "ngram_join" or n == len(rows) - 1)
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_staged_tables_are_released(spark):
    from meadowlark.llm.common import release

    release(spark)
    kept = staged(spark.range(3), "kept")
    path = Path(kept.inputFiles()[0].removeprefix("file://")).parent
    assert path.exists() and release(spark) == 1 and not path.exists() and release(spark) == 0


def test_registry():
    names = queries.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14)) and "pipeline" in names
    assert set(queries.oracle_sql()) <= set(names)
