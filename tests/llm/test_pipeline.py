import zlib

import corpus_pipeline as p
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lodestone.llm import quality

from .test_decontaminate import brute as hits
from .test_neardup import brute as groups
from .test_substrings import brute as repeats

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    try:
        return spark.read.parquet(f"{SF}/documents.parquet")
    except Exception:
        pytest.skip("needs the generated tables")


def test_every_stage_against_brute_force(spark, docs):
    stage = dict(p.STAGES)
    assert list(stage) == ["quality_classifier", "near_dedup", "substring_dedup", "decontamination", "best_fit_packing"]
    before = {r.doc_id: r.text for r in docs.collect()}

    kept = stage["quality_classifier"](spark, docs, SF)
    assert kept.columns == docs.columns and kept.schema.simpleString() == docs.schema.simpleString()
    net = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {d: t for d, t in before.items() if net.score([(t or "").encode()])[0] >= 0.7}
    kept = p.materialise(kept, "test")
    assert {r.doc_id: r.text for r in kept.collect()} == good

    apart = p.materialise(stage["near_dedup"](spark, kept, SF), "test")
    one = {d: good[d] for d, _, root in groups(sorted(good.items())) if d == root}
    assert apart.columns == docs.columns and {r.doc_id: r.text for r in apart.collect()} == one

    new = p.materialise(stage["substring_dedup"](spark, apart, SF), "test")
    want = {d: t if n else one[d] for d, (_, n, t) in repeats(list(one.items())).items()}
    rows = {r.doc_id: r for r in new.collect()}
    assert new.columns == docs.columns and {d: r.text for d, r in rows.items()} == want
    assert all(r.n_chars == len(r.text) for d, r in rows.items() if r.text != one[d])

    clean = p.materialise(stage["decontamination"](spark, new, SF), "test")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    left = {d: want[d] for d, *_, bad in hits(sorted(want.items()), items) if not bad}
    assert clean.columns == docs.columns and {r.doc_id: r.text for r in clean.collect()} == left

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    packed = stage["best_fit_packing"](spark, clean, SF).collect()
    ids = {d: t.encode(x or "", add_special_tokens=False).ids + [0] for d, x in left.items()}
    assert {(r.doc_id, r.piece, r.ids_crc32) for r in packed} == {(d, k, zlib.crc32(np.array(x[2048 * k : 2048 * (k + 1)], "<u4").tobytes())) for d, x in ids.items() for k in range(-(-len(x) // 2048))}
    assert sorted((r.doc_id, r.sequence_id, r.offset) for r in p.run(spark, SF).collect()) == sorted((r.doc_id, r.sequence_id, r.offset) for r in packed)
