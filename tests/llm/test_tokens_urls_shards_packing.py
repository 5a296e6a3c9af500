import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from lodestone.llm import packing, sharding, tokencount, urlfilter

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()), T.StructField("score", T.StringType()), T.StructField("shard", T.StringType())])
TEXTS = [
    "", None, " ", "Hello, world.. It's 12.5, isn't it?", "<|endoftext|> a<|endoftext|>", "a <|EndOfText|> b", "É é ΑΣ İ x.'s a.b,c", "a\x1cb\x85c\xa0d  e\n\n f",
    "word " * 5000, "x" * 3000, "\u0378 new", "naïve Straße １２ ﬁ",
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, ["a", "b", None][i % 3], "s", "t") for i, t in enumerate(TEXTS)] + [(None, "no id", "a", None, None), (3, TEXTS[3], "a", None, None)], DOCS)


def test_token_counts_equal_the_library(docs):
    t = Tokenizer.from_file(BYTE)
    for r in tokencount.count_tokens(docs, BYTE).collect():
        text = "no id" if r.doc_id is None else TEXTS[r.doc_id] or ""
        n = len(t.encode(text, add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(text.encode()), n > 1024)


def test_pattern_agrees_on_every_assigned_character():
    pre, odd = Tokenizer.from_file(BYTE).pre_tokenizer, tokencount.unassigned()
    chars = [c for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000 and c not in odd]
    for lo in range(0, len(chars), 20_000):
        for probe in ("a{}a\n", "1{}1\n", "!{}!\n"):
            text = "".join(probe.format(c) for c in chars[lo : lo + 20_000])
            assert [b for _, (_, b) in pre.pre_tokenize_str(text)] == [m.end() for m in regex.finditer(tokencount.PATTERN, text)]


def test_packing(docs):
    t = Tokenizer.from_file(WORD)
    placed = packing.pack(packing.pieces(docs, WORD), group_rows=8)
    rows = placed.collect()
    assert len({r.doc_id for r in rows}) == len(TEXTS) + 1
    by_sequence = {}
    for r in rows:
        if r.doc_id is not None:
            ids = t.encode(TEXTS[r.doc_id] or "", add_special_tokens=False).ids + [0]
            assert np.frombuffer(r.ids, "<u4").tolist() == ids[2048 * r.piece : 2048 * (r.piece + 1)]
            assert (r.start, r.length) == (2048 * r.piece, len(r.ids) // 4)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    whole = packing.sequences(placed).collect()
    assert {r.sequence_id: r.n_tokens for r in whole} == {k: sum(n for _, n in v) for k, v in by_sequence.items()}
    assert all(len(r.ids) == 4 * r.n_tokens for r in whole)
    crc = placed.filter("doc_id = 3").select(F.crc32("ids").alias("c"), "ids").first()
    assert crc.c == zlib.crc32(crc.ids)


def test_best_fit_is_bounded_and_tight():
    rng = random.Random(1)
    lengths = [rng.randint(1, 1500) for _ in range(5000)]
    for open_bins, slack in ((1, 2.0), (64, 1.1), (4096, 1.03)):
        bins, offsets = packing.best_fit(lengths, 2048, open_bins)
        filled = {}
        for b, o, n in zip(bins, offsets, lengths, strict=True):
            assert filled.get(b, 0) == o
            filled[b] = o + n
        assert max(filled.values()) <= 2048
        assert len(filled) <= slack * sum(lengths) / 2048 + 1


def naive_best_fit(lengths, capacity, open_bins):
    """Open bins in a plain list: the fullest that takes the piece, the one opened or filled last of equals; the fullest closes."""
    free, bins, offsets, made = [], [], [], 0
    for n in lengths:
        fit = min((f for f, _ in free if f >= n), default=None)
        if fit is None:
            if len(free) == open_bins:
                least = min(f for f, _ in free)
                free.pop(max(i for i, (f, _) in enumerate(free) if f == least))
            fit, k, made = capacity, made, made + 1
        else:
            k = free.pop(max(i for i, (f, _) in enumerate(free) if f == fit))[1]
        bins.append(k)
        offsets.append(capacity - fit)
        if fit > n:
            free.append((fit - n, k))
    return bins, offsets


@pytest.mark.parametrize("open_bins", [1, 7, 100, 5000])
def test_best_fit_equals_naive_best_fit(open_bins):
    rng = random.Random(open_bins)
    for most in (3, 60, 200):
        lengths = [rng.randint(1, most) for _ in range(2500)] + sorted((rng.randint(1, most) for _ in range(500)), reverse=True)
        assert packing.best_fit(lengths, 200, open_bins) == naive_best_fit(lengths, 200, open_bins)


def test_packing_deals_equal_rows_out_and_fills(spark, monkeypatch):
    monkeypatch.setattr(packing, "SAME", 20)
    rng = random.Random(4)
    rows = [(None, 0, 100)] * 3000 + [(i, 0, rng.choice([5, 40, 300, 1200, 2048])) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, length long").selectExpr("*", "'x' as text", "0 as offset_", "1 as `__x`")
    got = packing.pack(df, group_rows=500).collect()
    assert sorted((str(r.doc_id), r.length) for r in got) == sorted((str(d), n) for d, _, n in rows)
    copies = [r.sequence_id >> 40 for r in got if r.doc_id is None]
    assert len(set(copies)) == 12 and max(copies.count(g) for g in set(copies)) < 400
    assert len({r.sequence_id for r in got}) < 1.03 * sum(n for *_, n in rows) / 2048


def test_words_are_remembered_in_two_generations(monkeypatch):
    monkeypatch.setattr(packing, "GENERATION", 50)
    ids, t, rng = packing.WordIds(WORD), Tokenizer.from_file(WORD), random.Random(3)
    assert ids.by_word
    for _ in range(30):
        texts = [" ".join(rng.choice(["the", "of", "naïve", "x.y", "12,5", f"w{rng.randrange(90)}", "ab" * 40]) for _ in range(30)) for _ in range(5)]
        assert [np.frombuffer(x, "<u4").tolist() for x in ids([x.encode() for x in texts])] == [t.encode(x, add_special_tokens=False).ids for x in texts]
        assert len(ids.known) < 200 and not any(len(w) > packing.LONGEST for w in ids.known)


def test_cut_words_leave_no_token_across():
    words, upto = packing.cut_words([b"", "Été 12 (don't) x-y".encode(), b" \t", "H\u0331e".encode()])
    assert words.to_pylist() == [w.encode() for w in ["été", "1", "2", "(", "don", "'t", ")", "x", "-", "y", "H\u0331e"]] and upto.tolist() == [0, 10, 10, 11]
    assert packing.cut_words([b"A.b C"], finely=False)[0].to_pylist() == [b"A.b", b"C"] and len(packing.cut_words([b"", b""])[0]) == 0
    ids, t, rng = packing.WordIds(WORD), Tokenizer.from_file(WORD), random.Random(4)
    parts = [*"ahtwyjkHTWYJK019éÀßÞ×÷ÿ'.,;-=>( \t\x1c\xa0\u2028\u0301\u0308\u030a\u0331\u0338Σİ가", "'s", "'re", "'ll ", "the ", "<|endoftext|>"]
    for several in (parts[:-1], parts):  # capitals under combining characters were lower-cased too early
        texts = ["".join(rng.choices(several, k=rng.choice([0, 1, 3, 30]))) for _ in range(400)]
        assert [np.frombuffer(x, "<u4").tolist() for x in ids([x.encode() for x in texts])] == [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert ids([b"", b" "]) == [b"", b""] and ids([]) == []


def test_other_tokenizer_files_encode_whole_texts():
    ids, t = packing.WordIds(BYTE), Tokenizer.from_file(BYTE)
    assert not ids.by_word
    texts = [x for x in TEXTS if x]
    assert [np.frombuffer(x, "<u4").tolist() for x in ids([x.encode() for x in texts])] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_packing_refuses_what_cannot_fit(spark):
    with pytest.raises(Exception, match="piece's length"):
        packing.pack(spark.createDataFrame([(1, 0, 9)], "doc_id long, piece int, length long"), capacity=8).collect()


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert tokencount.count_tokens(none, BYTE).count() == 0
    assert packing.pack(packing.pieces(none, WORD)).count() == 0
    assert sharding.interleave(none, 4).count() == 0
    assert urlfilter.judge_urls(none.select(F.col("doc_id").alias("page_id"), F.col("text").alias("url")), [("a/", "block")]).count() == 0


def test_sharding(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("s"), F.col("id") % 7)).alias("source"))
    rows = sharding.interleave(docs, 7).toPandas()
    assert len(rows) == 3000 and rows.doc_id.is_unique
    sizes = rows.groupby("shard").size()
    assert len(sizes) == 7 and sizes.max() - sizes.min() <= 1
    for _, s in rows.groupby("shard"):
        assert sorted(s.slot) == list(range(len(s)))
    rows["source"] = ["hot" if i % 3 == 0 else f"s{i % 7}" if i % 3 == 1 else "none" for i in rows.doc_id]
    for _, s in rows.groupby("source"):
        share = s.groupby("shard").size().reindex(range(7), fill_value=0)
        assert share.max() - share.min() < rows.source.nunique()
    again = sharding.interleave(docs.repartition(5, "text"), 7).toPandas()
    assert again.sort_values("doc_id")[["shard", "slot"]].values.tolist() == rows.sort_values("doc_id")[["shard", "slot"]].values.tolist()
    assert rows.text_crc32[rows.doc_id == 5].item() == zlib.crc32(b"t5")


def test_sharding_equals_plain_ranking(spark):
    """Every row ranked in plain Python: nulls, ties, repeated rows, a hot stratum."""
    import hashlib

    rng = random.Random(8)
    rows = [(None if rng.random() < 0.1 else rng.randrange(400), rng.choice(["", None, "a", "b" * 9, "é", str(rng.random())]), rng.choice(["hot"] * 4 + ["s1", "s2", None])) for _ in range(900)]
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    strata = {}
    for d, t, s in rows:
        b = (t or "").encode()
        digest = md5(f"7:{d if d is not None else 'null' + md5(t or '')}")
        strata.setdefault("null" if s is None else f"={s}", []).append((digest, -1 if d is None else d, zlib.crc32(b), len(b) + 1, d))
    order = []
    for name, some in strata.items():
        for k, (_, _, crc, size, d) in enumerate(sorted(some), 1):
            order.append(((2 * k - 1) / (2 * len(some)), name, k, d, size, crc))
    order.sort(key=lambda x: x[:3])
    want, seen = [], {}
    for p, (_, _, _, d, size, crc) in enumerate(order):
        shard = p * 5 // len(order)
        want.append((str(d), size, crc, shard, seen.get(shard, 0)))
        seen[shard] = seen.get(shard, 0) + 1
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6).selectExpr("*", "'x' as shard", "1 as slice", "2 as stratum")
    got = [(str(r.doc_id), r["size"], r.text_crc32, r.shard, r.slot) for r in sharding.interleave(df, 5).collect()]
    assert sorted(got) == sorted(want)


def test_very_long_texts(spark):
    """One text of some million bytes beside short ones: counts, pieces, shard sizes and url rules."""
    long = "lorem ipsum, dolor. " * 60_000
    df = spark.createDataFrame([(1, long, "a"), (2, "x", "a"), (3, "é" * 500_000, "b")], "doc_id long, text string, source string")
    t = Tokenizer.from_file(BYTE)
    got = {r.doc_id: r.n_tokens for r in tokencount.count_tokens(df, BYTE).collect()}
    assert got == {d: len(t.encode(x, add_special_tokens=False).ids) for d, x in ((1, long), (2, "x"), (3, "é" * 500_000))}
    w = Tokenizer.from_file(WORD)
    rows = packing.pack(packing.pieces(df, WORD)).collect()
    for d, x in ((1, long), (2, "x")):
        ids = w.encode(x, add_special_tokens=False).ids + [0]
        mine = sorted((r.piece, r.ids) for r in rows if r.doc_id == d)
        assert np.frombuffer(b"".join(i for _, i in mine), "<u4").tolist() == ids
    assert {r.doc_id: r["size"] for r in sharding.interleave(df, 2).collect()} == {1: len(long) + 1, 2: 2, 3: 1_000_001}
    url = "http://a.example.org/es/" + "x" * 300_000 + "?" + "y" * 300_000
    judged = urlfilter.judge_urls(spark.createDataFrame([(1, url)], "page_id long, url string"), [("example.org/es/", "block")]).first()
    assert judged.rule == "example.org/es/" and len(judged.path) == 300_004


def test_sharding_odd_rows(docs):
    rows = sharding.interleave(docs, 4).collect()
    assert len(rows) == len(TEXTS) + 2 and {r["size"] for r in rows if r.doc_id == 1} == {1}


def test_url_rules(spark):
    rules = [("org/", "allow"), ("example.org/es/", "block"), ("org/es/abcdefghijk", "allow"), ("x.com/", "block")]
    urls = {
        "http://a.EXAMPLE.org/es/1": ("a.example.org", "/es/1", "example.org/es/", "block"), "http://example.org/es/abcdefghijkl?q": ("example.org", "/es/abcdefghijkl", "org/es/abcdefghijk", "allow"),
        "http://example.org": ("example.org", "", None, "allow"), "ftp://myexample.org/es/": ("myexample.org", "/es/", "org/", "allow"), "nourl": ("", "", None, "allow"), None: ("", "", None, "allow"),
        "http://x.com?a://b/": ("x.com", "", None, "allow"), "http://é.x.com/#f": ("é.x.com", "/", "x.com/", "block"), "a://b://x.com/": ("b:", "//x.com/", None, "allow"), "": ("", "", None, "allow"),
    }
    got = urlfilter.judge_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).orderBy("page_id").collect()
    assert [tuple(r)[1:] for r in got] == list(urls.values())


def test_url_index_confirms_strings(tmp_path):
    index = urlfilter.Index(urlfilter.build_index([("a/", "block"), ("b/", "allow")], str(tmp_path)))
    index.keys = np.repeat(index.keys[:1], 2)  # a collision
    stored = [index.rule(0), index.rule(1)]
    import xxhash

    hit = next(s for s in ("a/", "b/") if xxhash.xxh64_intdigest(s) == index.keys[0])
    assert index.rule(index.probe([hit])[0]) == hit and index.probe(["c/"])[0] == -1 and sorted(stored) == ["a/", "b/"]
