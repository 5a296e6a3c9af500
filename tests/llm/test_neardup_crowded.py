"""Links that rest on crowded values although these describe one of the documents in part only, or stand late among its values."""

import numpy as np
import pytest

from lodestone.llm import neardup

from .test_neardup import brute

PASSAGE = [f"a500x{i}" for i in range(304)]  # 300 sets of words, of which none has a very small hash


def values(words):
    return neardup.shingles(" ".join(words).encode(), 5)[: neardup.INDEXED]


def found(spark, docs):
    rows = neardup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)


@pytest.mark.parametrize("tail", ["unique", "crowded"])
def test_passage_with_a_third_more(spark, tail):
    more = [f"u909x{i}" if tail == "unique" else f"c44x{i}" for i in range(100)]
    families = [PASSAGE] if tail == "unique" else [PASSAGE, PASSAGE[-4:] + more]
    texts = [PASSAGE, PASSAGE + more] + [f + [f"n{i}", f"m{i}"] for f in families for i in range(60)]
    shared = np.isin(values(texts[1]), values(PASSAGE))
    assert shared.sum() in range(5, 10) if tail == "unique" else not shared[:8].any() and shared[:12].any()
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    want = brute(docs)
    assert (1, 400, 0) in want
    assert found(spark, docs) == want


def test_rows_of_one_id(spark):
    """Ids of different texts, each of which may hold the id's only link, be a copy of another id's or be empty."""
    text = lambda name, n=40: [f"{name}{i}" for i in range(n)]
    docs = []
    for i in range(8):  # another text of the id must not stand for the linked one, whichever has the greater digest
        docs += [(10 * i, text(f"p{i}x")), (10 * i + 1, text(f"q{i}x", 41)), (10 * i + 1, text(f"p{i}x", 41)), (10 * i + 2, text(f"q{i}x"))]
    docs += [(100, text("r")), (101, text("r")), (101, text("s")), (102, []), (102, text("r")), (103, text("s") + ["end"]), (104, []), (None, text("s"))]
    docs = [(i, " ".join(t)) for i, t in docs]
    assert found(spark, docs) == brute(docs)


def test_ten_thousand_documents_linked_by_crowded_values_alone(spark):
    """Families of documents, and chains of documents between them, of which a link shares nothing but what many documents share."""
    base = [[f"f{k}x{i}" for i in range(60)] for k in range(61)]
    texts = [base[k] + [f"n{k}x{i}", f"m{k}x{i}"] for k in range(61) for i in range(155)]
    for k in range(60):
        texts += [base[k][t:] + base[k + 1][:t] for t in range(6, 60, 6) if k % 2 == 0 or t != 30]  # every other chain is broken
    assert len(texts) > 9_900
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    want = brute(docs)
    assert len({root for *_, root in want}) == 31
    assert found(spark, docs) == want


@pytest.mark.parametrize("tile", [2, 64])
def test_blocks_and_slices_of_one_hot_value(spark, monkeypatch, tile):
    monkeypatch.setattr(neardup, "TILE", tile)
    monkeypatch.setattr(neardup, "BLOCK", 16)
    monkeypatch.setattr(neardup, "BLOCK_BYTES", 4096)
    monkeypatch.setattr(neardup, "COLUMNS", 300)
    base = [[f"g{k}x{i}" for i in range(60)] for k in range(4)]
    texts = [base[k] + [f"n{k}x{i}", f"m{k}x{i}"] for k in range(4) for i in range(70)] + [base[k][t:] + base[k + 1][:t] for k in range(3) for t in range(6, 60, 6)]
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    assert found(spark, docs) == brute(docs)


def test_very_long_texts(spark):
    long = " ".join(f"w{i * 7 % 100_003}" for i in range(200_000))
    docs = [(1, long), (2, long + " and more"), (3, "x " + long), (4, long[: len(long) // 2]), (5, "a b c d e f")]
    assert found(spark, docs) == brute(docs)


def test_every_pair_that_shares_a_value_can_be_verified(spark):
    docs = [(i, " ".join([f"g{x}" for x in range(60)] + [f"n{i}x{j}" for j in range(i % 20)])) for i in range(120)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(df, likely=0.0, mostly=0.0).collect())
    assert got == sorted(x[:3] for x in brute(docs))
