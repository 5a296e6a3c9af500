import random

import pytest

from lodestone.llm import substrings


def brute(docs, window=20):
    """For each document: words, removed words, and the text that stays."""
    first, out = {}, {}
    docs = sorted((d, t or "") for d, t in docs)
    for d, t in docs:
        w = t.encode().split()
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), (d, i))
    for d, t in docs:
        w = t.encode().split()
        gone = {j for i in range(len(w) - window + 1) if first[tuple(w[i : i + window])] < (d, i) for j in range(i, i + window)}
        out[d] = len(w), len(gone), " ".join(x.decode() for i, x in enumerate(w) if i not in gone)
    return out


def texts(seed):
    rng = random.Random(seed)
    word = lambda n=400: f"w{rng.randrange(n)}"
    passages = [[word() for _ in range(n)] for n in (20, 21, 33, 60, 150)]
    docs = ["", None, " \t\n", "a b c", "same " * 70, " ".join(["x", "y"] * 60), " ".join(passages[3]), " ".join(passages[3][:19])]
    for _ in range(60):
        w = [word() for _ in range(rng.randrange(30))]
        for _ in range(rng.randrange(4)):
            p = list(rng.choice(passages))
            if rng.random() < 0.3:
                p[rng.randrange(len(p))] = word()
            w += p[rng.randrange(3) :] + [word() for _ in range(rng.randrange(30))]
        docs.append(" ".join(w))
    return docs + rng.sample(docs[8:], 15)


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("batch", [substrings.BATCH, 3000])
def test_equals_brute_force(spark, monkeypatch, seed, batch):
    monkeypatch.setattr(substrings, "BATCH", batch)
    monkeypatch.setattr(substrings, "CROWD", 4)
    docs = list(enumerate(texts(seed)))
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in substrings.remove_repeats(rows).collect()}
    assert {d: (r.n_words, r.n_removed, r.kept) for d, r in got.items()} == brute(docs)
    assert all(sum(s.stop - s.start for s in r.spans) == r.n_removed for r in got.values())


def test_odd_rows(spark):
    p = " ".join(f"p{i}" for i in range(30))
    rows = [(None, p), (None, p), (1, p), (1, p), (2, "q " + p), (2, "other"), (3, None)]
    df = spark.createDataFrame([(d, t, "k", "v", 1) for d, t in rows], "doc_id long, text string, kept string, place string, key int")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r["key"]) for r in substrings.remove_repeats(df, carry=("key",)).collect())
    assert got == [(False, 1, 30, 0, 1), (False, 1, 30, 0, 1), (False, 2, 1, 0, 1), (False, 2, 31, 30, 1), (False, 3, 0, 0, 1), (True, 0, 30, 0, 1), (True, 0, 30, 0, 1)]
    assert substrings.remove_repeats(df.limit(0)).count() == 0


def test_one_very_long_text(spark):
    rng = random.Random(5)
    long = " ".join(f"w{rng.randrange(5000)}" for _ in range(150_000))
    df = spark.createDataFrame([(1, long), (2, "tail " + long)], "doc_id long, text string")
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept[:4]) for r in substrings.remove_repeats(df).collect()}[2] == (150_001, 150_000, "tail")


def test_many_texts_of_one_id(spark):
    """Each text of an id is a document of its own, however many there are; a later id's copies of them go."""
    texts_ = [" ".join(f"t{k}x{i}" for i in range(25)) for k in range(400)]
    rows = [(7, t) for t in texts_] + [(7, texts_[0])] + [(8 + k, "new " + t) for k, t in enumerate(texts_)]
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 801 and all(r.n_removed == 0 for r in got if r.doc_id == 7)
    assert all((r.n_removed, r.kept) == (25, "new") for r in got if r.doc_id > 7)
    assert len({r.kept for r in got if r.doc_id == 7}) == 400
