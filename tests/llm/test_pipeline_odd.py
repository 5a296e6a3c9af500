"""The five stages over odd tables: nulls in any column, empty and very long texts, repeated ids and rows, extra columns, no rows."""

import corpus_pipeline as p
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    good = lambda k: " ".join(f"word{k}x{i} and then" for i in range(40))
    bad = lambda k: " ".join(f"@@{k}$$ !!{i}%%" for i in range(60))
    rows = [(i, good(i) if i % 2 else bad(i), "en", "a", 1) for i in range(80)]
    item = " ".join(f"test{i}" for i in range(40))
    rows += [
        (None, good(500), "en", "a", 1), (None, good(500), None, None, None), (None, None, None, None, None), (101, good(501), "en", "a", 1), (101, good(501), "en", "a", 1), (101, good(502), "en", "b", 2),
        (103, good(501), "en", "a", 3), (105, None, "en", "a", 0), (107, "", "en", "a", 0), (109, item, "en", "a", 9), (111, good(503) + " " + good(1), "de", "b", 5), (113, " ".join(good(k) for k in range(600, 700)), "en", "a", 7),
    ]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, i % 2, 0) for i in range(80)] + [(None, 1, 0), (3, None, None), (999, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([("t1", item), (None, "a b"), ("t2", None)], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def with_extra(df):
    """Columns that have names of the operators' own."""
    return df.selectExpr("*", "'x' as node", "1 as piece", "2 as length", "'k' as kept", "3 as score", "array(1) as spans", "'t' as tag", "5 as sequence_id")


@pytest.mark.parametrize("name", [n for n, _ in p.STAGES])
def test_each_stage_on_odd_rows(spark, tables, name):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    stage = dict(p.STAGES)[name]
    got = p.materialise(stage(spark, with_extra(docs), tables), "odd")
    ids = [r.doc_id for r in got.collect()]
    if name != "best_fit_packing":
        assert got.columns == docs.columns and got.schema.simpleString() == docs.schema.simpleString()
        assert got.exceptAll(docs).count() == 0 or name == "substring_dedup"
    if name == "near_dedup":
        assert 103 not in ids and ids.count(101) == 3 and ids.count(None) == 3 and 105 in ids and 107 in ids
    if name == "substring_dedup":
        texts = {r.doc_id: r.text for r in got.collect()}
        assert len(ids) == docs.count() and texts[103] == "" and texts[105] in (None, "") and "word1x5" not in texts[111]
    if name == "decontamination":
        assert 109 not in ids and len(ids) == docs.count() - 1
    if name == "best_fit_packing":
        assert set(ids) == {r.doc_id for r in docs.collect()}
    empty = stage(spark, docs.limit(0), tables)
    assert empty.count() == 0


def test_whole_run(spark, tables):
    rows = p.run(spark, tables).collect()
    ids = {r.doc_id for r in rows}
    assert 109 not in ids and 103 not in ids and {1, 3, 113} <= ids
    ends = {}
    for r in rows:
        ends.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in ends.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048


def test_stages_leave_only_the_last_result(spark, tables):
    import os

    from lodestone.llm.common import shared_dir

    folder = shared_dir(spark)
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    out = p.run(spark, tables)
    left = set(os.listdir(folder)) - before
    assert len(left) == 1 and left.pop().startswith("best_fit_packing") and out.count() >= 0
