import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lodestone.llm import alignment as al

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute(rows):
    """The libraries on whole texts, offsets by plain loops."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}
    found, times = [], Counter()
    for doc, text in rows:
        if not text:
            found.append((doc, None))
            continue
        ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw = [bytes(byte[c] for c in a.id_to_token(i)) for i in ids[0]], [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]]
        if any(b"".join(r) != (" " + text).encode() for r in raw):
            found.append((doc, None))
            continue
        ends = [[sum(map(len, r[: i + 1])) for i in range(len(r))] if len(r) < 500 else _ends(r) for r in raw]
        last = [dict(zip(e, range(len(e)), strict=True)) for e in ends]
        common = sorted(set(ends[0]) & set(ends[1]))
        links = [(ids[0][last[0][e]], ids[1][last[1][e]]) for e in common]
        times.update(links)
        starts = [0, *common[:-1]]
        cut = lambda k, lo, hi: ",".join(str(i) for i, e in zip(ids[k], ends[k], strict=True) if lo < e <= hi)
        groups = None if len(common) > 2000 else ";".join(cut(0, lo, hi) + "|" + cut(1, lo, hi) for lo, hi in zip(starts, common, strict=True))
        found.append((doc, (len(ids[0]), len(ids[1]), links, groups)))
    top = Counter()
    for (_, y), n in times.items():
        top[y] = max(top[y], n)
    out = []
    for doc, x in found:
        if x is None:
            out.append((doc, 0, 0, 0, 0, 0, 0, ""))
        else:
            n_a, n_b, links, groups = x
            out.append((doc, n_a, n_b, len(links), len(links), sum(times[p] == top[p[1]] for p in links), sum(times[p] for p in links), groups and hashlib.sha256(groups.encode()).hexdigest()))
    return out


def _ends(raw):
    out, at = [], 0
    for x in raw:
        at += len(x)
        out.append(at)
    return out


def texts(seed):
    rng = random.Random(seed)
    alphabet = ["the", "ciónes", " ", "  ", "\n", "\t", "'s", "<|endoftext|>", "<s>", "<0x41>", "▁", "日本語", "🙂", "é", "́", "\xa0", " ", "12345", "!!!", "A", "\x00", "\x1c", "͸", "ſ"]
    out = ["", None, " ", "   ", "a ", " a", "\n", "a\n\nb", "word " * 40, "x" * 200, "▁x", "the ▁ of"]
    return out + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(80)]


@pytest.mark.parametrize("chunk,part", [(1 << 20, 1 << 20), (150, 40)])
def test_equals_brute_force(spark, monkeypatch, chunk, part):
    monkeypatch.setattr(al, "CHUNK", chunk)
    monkeypatch.setattr(al, "PART", part)
    monkeypatch.setattr(al, "HELD", 30 if part == 40 else 500_000)
    rng = random.Random(part)
    rows = [(i if i % 9 else None, t) for i, t in enumerate(texts(part))] + [(7, "same words again"), (7, "same words again")]
    rows += [(500 + i, " ".join(rng.choice(["the", "of", "ciónllga", "thbleor", "x1"]) for _ in range(100))) for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_a", "2 as b").repartition(3)
    got = [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in al.align(df, A, B).collect()]
    order = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted(got, key=order) == sorted(brute(rows), key=order)


def test_very_long_text_goes_in_parts():
    rng = random.Random(3)
    text = " " + " ".join(rng.choice(["the", "ñas", "doosñ", "of\n\nand", "1 2"]) for _ in range(20_000))
    cut = al.parts(text, 1000)
    assert "".join(cut) == text and len(cut) > 50 and max(map(len, cut)) < 1200
    a, b = al._coders(A, B)
    whole, row = (next(al._rows(iter([text[1:]]), a, b, 1 << 20, size))[0] for size in (1 << 20, 1000))
    assert whole.right and whole.counts == row.counts and whole.sha.hexdigest() == row.sha.hexdigest()
    assert whole.counts[:2] == [len(a.tokenizer.encode(text, add_special_tokens=False).ids), len(b.model.encode(text[1:]))]
    assert sorted(whole.pairs[0].to_pylist(), key=str) == sorted(row.pairs[0].to_pylist(), key=str)


def test_pairs_are_bounded_by_the_vocabularies():
    assert 300_000 < al.most_pairs(A, B) < 400_000


def test_empty_table_and_nulls(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert al.align(df, A, B).count() == 0
    rows = al.align(spark.createDataFrame([(None, None)], "doc_id long, text string"), A, B).collect()
    assert [tuple(r) for r in rows] == [(None, 0, 0, 0, 0, 0, 0, "")]


def test_pattern_of_latin_texts_is_the_same():
    whole, latin = al.regex.compile(al.PATTERN), al.re.compile(al.LATIN)
    for c in map(chr, range(256)):
        for d in "a 1.'\n":
            for t in (c + d, d + c, c + c + d + c, f"a{c}{d}{c} b"):
                assert whole.findall(t) == latin.findall(t)
