import os
import zlib

import numpy as np
import pytest

from lodestone.llm import quality

SF = "/root/testdata/sf0.1"


def test_gradients_are_the_slopes():
    net = quality.Network(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    net.windows = lambda data: np.stack([net.p["embed"][data[i : i + quality.WIDTH]].ravel() for i in range(0, len(data) - quality.WIDTH, quality.STRIDE)])
    rng = np.random.default_rng(0)
    net.p["conv_b"] += 0.1 + rng.random(quality.FILTERS)  # padding answers 0 + bias: off the rectifier's corner
    texts, y = [rng.bytes(n).replace(b"\0", b"a") for n in (3, 300, 900, 0)], np.array([0.0, 1, 0, 1])
    loss = lambda: -(y * np.log(p := net.head(net.block_maxima(net.lay_out(texts)[0])[0], net.lay_out(texts)[1])["p"]) + (1 - y) * np.log(1 - p)).mean()
    g = net.gradients(texts, y)
    for name, p in net.p.items():
        for k in rng.choice(p.size, min(12, p.size), replace=False):
            if name == "embed" and k < quality.EMBED:
                continue
            old, e = p.flat[k], 1e-6
            p.flat[k] = old + e
            up = loss()
            p.flat[k] = old - e
            down = loss()
            p.flat[k] = old
            assert abs((up - down) / (2 * e) - g[name].flat[k]) < 1e-4, name


def test_score_sees_the_whole_text():
    net = quality.Network(2)
    base = b"quiet text. " * 60_000
    a, b = net.score([base, base[:-40] + b"\xff\xfe!!ZZ" * 5])
    assert a != b
    one, many = net.score([b"x" * 999]), net.score([b"", base, b"x" * 999])
    assert abs(one[0] - many[2]) < 1e-5 and 0 <= many[0] <= 1


def test_learns_and_holds_out(spark):
    rows = [(i, ("good words here. " if i % 2 else "%%## !!BAD BAD ") * (1 + i % 9), i % 2) for i in range(400)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(None, None), (1, rows[1][1])], "doc_id long, text string").selectExpr("*", "'x' as score", "0 as held_out")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (7, 0), (9, None)], "doc_id long, quality int")
    got = quality.score(docs, quality.train(docs, labels, rows=200)).collect()
    assert len(got) == 402
    right = [r.predicted == r.doc_id % 2 for r in got if r.held_out]
    assert np.mean(right) > 0.95
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    untrained = quality.train(docs, labels.limit(0))
    assert quality.score(docs.limit(0), untrained).count() == 0 and quality.score(docs, untrained).count() == 402


def plain_score(net, text):
    """The probability of one text, window by window in plain loops."""
    p = {k: v.astype(np.float64) for k, v in net.p.items()}
    data = bytes(quality.WIDTH - quality.STRIDE) + text
    n = -(-len(data) // quality.BLOCK)
    data = data.ljust(n * quality.BLOCK + quality.WIDTH, b"\0")
    tops = []
    for block in range(n):
        best = np.full(quality.FILTERS, -np.inf)
        for at in range(block * quality.BLOCK, (block + 1) * quality.BLOCK, quality.STRIDE):
            best = np.maximum(best, np.concatenate([p["embed"][c] for c in data[at : at + quality.WIDTH]]) @ p["conv"] + p["conv_b"])
        tops.append(best)
    chunks = [np.maximum(np.maximum(tops[i], tops[min(i + 1, n - 1)]), 0) for i in range(n)]
    h = np.array([np.tanh(m @ p["chunk"] + p["chunk_b"]) for m in chunks])
    z = np.concatenate([h.max(axis=0), h.mean(axis=0)]) @ p["out"][:, 0] + p["out_b"][0]
    return 1 / (1 + np.exp(-z))


def test_scores_equal_a_plain_forward_pass_whatever_stands_beside():
    net, rng = quality.Network(3), np.random.default_rng(2)
    texts = [b"", b"x", rng.bytes(252), rng.bytes(253), rng.bytes(256), "é".encode() * 700, rng.bytes(5000)]
    want = [plain_score(net, t) for t in texts]
    np.testing.assert_allclose(net.score(texts), want, atol=1e-5)
    np.testing.assert_allclose(net.score(texts[::-1]), want[::-1], atol=1e-5)


def test_training_with_ties_and_clashing_names(spark):
    """Ids of several rows and of two labels, equal texts, columns that have names of the operator's own."""
    rows = [(i % 60, ("fine words. " if i % 2 else "@@@@ $$$$ ") * 5, i % 2) for i in range(120)]
    docs = spark.createDataFrame([(d, t) for d, t, _ in rows], "doc_id long, text string").selectExpr("*", "'x' as id", "2 as label", "3 as score")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(4, 1), (4, 0)], "doc_id long, quality int").selectExpr("*", "0 as label", "'a' as text")
    one, two = (quality.train(docs.repartition(n), labels) for n in (1, 5))
    assert all((one.p[k] == two.p[k]).all() for k in one.p)
    got = quality.score(docs, one).collect()
    assert len(got) == 120 and np.mean([r.predicted == r.doc_id % 2 for r in got]) > 0.95


@pytest.mark.skipif(not os.path.exists(SF), reason="needs the generated tables")
@pytest.mark.parametrize("sf,good_kept,bad_rejected", [(SF, 0.95, 0.90), ("/root/testdata/sf0.01", 0.75, 0.5)])
def test_held_out_accuracy(spark, sf, good_kept, bad_rejected):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.score(docs, quality.train(docs, labels)).join(labels, "doc_id").filter("held_out").toPandas()
    good, bad = got[got.quality == 1], got[got.quality == 0]
    assert (good.predicted == 1).mean() > good_kept and (bad.predicted == 0).mean() > bad_rejected
