"""Alignment of two tokenizers: where their tokens end at the same byte.

Work in the tasks is on Arrow columns. Texts are cut into words at places where no token of either
tokenizer reaches across; each distinct word of a chunk is encoded once and the ids are taken back by
dictionary index. Flattened id lists with their parent indices give byte ends by segmented cumulative
sums; a hash join on (document, end) finds the common ends, and `Table.group_by` counts the pairs of ids
that end together, first for each document, then for each task; Spark merges the partial counts.

Two tokens that end together are suffixes of one another, so the pairs that can occur are bounded by
the two vocabularies (`most_pairs`): that bound allows the merged counts to be broadcast.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .tokencount import LONGEST, PATTERN, unassigned

#: Characters of text that are aligned at once, and from which a text is aligned in parts.
CHUNK, PART = 2 << 20, 1 << 20
#: Words of each tokenizer that are remembered; longer ones than LONGEST never are.
REMEMBERED = 150_000
#: A text's number in a chunk stands above so many bits of a byte's place in it.
END_BITS = 40
#: Partial counts are merged in a task when so many rows of them are held.
HELD = 500_000

# Fixed value: PATTERN for texts of Latin-1 characters, its classes spelled out.
LETTER, NUMBER, BLANK = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", "\\t-\\r \\x85\\xa0"
LATIN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{BLANK}{LETTER}{NUMBER}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+"
# The second tokenizer's sign for a space, and the bytes that stand for themselves in byte-level vocabularies.
SPACE = "▁"
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def _byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    others = [b for b in range(256) if b not in PRINTABLE]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """Ids of texts by a byte-level BPE file whose pre-tokenizer is PATTERN; special strings in texts are plain text."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = True
        self.known = Memory()
        self.findall, self.latin, self.odd = regex.compile(PATTERN).findall, re.compile(LATIN).findall, unassigned()
        byte, special = _byte_of_char(), {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        names = {i: s for s, i in self.tokenizer.get_vocab().items()}
        token = lambda i: special[i].encode() if i in special else bytes(byte[c] for c in names.get(i, ""))
        self.bytes = pa.array([token(i) for i in range(max(names) + 1)], pa.binary())

    def whole(self, text: str) -> bool:
        """Whether only the library can tell the words of ``text``: it holds a character that is newer than one of the Unicode tables."""
        return not text.isascii() and not self.odd.isdisjoint(text)

    def words(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return [text] if self.whole(text) else self.findall(text)
        return self.latin(text)

    def encode(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]


class Pieces:
    """Ids of texts by a sentencepiece model. Words are cut before spaces if no piece has a space after another character."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.known = Memory()
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        token = lambda i: bytes([int(names[i][3:-1], 16)]) if self.model.is_byte(i) else names[i].replace(SPACE, " ").encode()
        self.bytes = pa.array([token(i) for i in range(len(names))], pa.binary())
        spec = sentencepiece_model_pb2.ModelProto.FromString(self.model.serialized_model_proto()).normalizer_spec
        plain = not spec.precompiled_charsmap and spec.add_dummy_prefix and not spec.remove_extra_whitespaces
        self.cut = plain and SPACE in names and not any(SPACE in s.lstrip(SPACE) for s in names)
        self.findall = re.compile(" *[^ ]+| +").findall
        self.space = self.model.piece_to_id(SPACE)

    def words(self, text: str) -> list[str]:
        return self.findall(text) if self.cut else [text]

    def encode(self, words: list[str]) -> list[list[int]]:
        """Of words that begin with a space, which the model adds itself."""
        ids = self.model.encode([w[1:] for w in words], num_threads=1)
        return [[self.space] if w == " " and self.cut else x for w, x in zip(words, ids, strict=True)]


@lru_cache(maxsize=2)
def _coders(a_path: str, b_path: str) -> tuple[ByteLevel, Pieces]:
    return ByteLevel(a_path), Pieces(b_path)


def most_pairs(a_path: str, b_path: str) -> int:
    """How many pairs of ids can end together: those of which one is a suffix of the other."""
    sides = [[x for x in c.bytes.to_pylist() if x] for c in _coders(a_path, b_path)]
    times = [{}, {}]
    for side, found in zip(sides, times, strict=True):
        for x in side:
            found[x] = found.get(x, 0) + 1
    longer = sum(times[1].get(x[i:], 0) for x in sides[0] for i in range(len(x)))
    return longer + sum(times[0].get(x[i:], 0) for x in sides[1] for i in range(1, len(x)))


class Memory:
    """The ids of words as bytes of int32, remembered from chunk to chunk: those of the last chunks, and before them those that were used again."""

    def __init__(self) -> None:
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def lists(self, parts: list[list[str]], encode) -> pa.ListArray:
        """The ids of every text, given as its words: each distinct word that is not remembered is encoded once."""
        if len(self.known) > REMEMBERED:
            self.known, self.before = {}, self.known
        known, before = self.known, self.before
        missing = set().union(*parts).difference(known)
        known.update((w, before[w]) for w in missing.intersection(before))
        new = list(missing.difference(before))
        known.update(zip(new, (array("i", x).tobytes() for x in encode(new)), strict=True))
        coded = list(map(known.__getitem__, chain.from_iterable(parts)))
        ends = np.zeros(len(coded) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)) >> 2, out=ends[1:])
        for word in new:
            if len(word) > LONGEST:
                del known[word]
        return pa.ListArray.from_arrays(pa.array(ends[np.cumsum([0, *map(len, parts)])], pa.int32()), pa.array(np.frombuffer(b"".join(coded), np.int32)))


def _bytes(ids: pa.ListArray, token: pa.Array) -> pa.Array:
    """The joined bytes of each list's tokens."""
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, token.take(pc.list_flatten(ids))), b"")


def _ends(ids: pa.ListArray, lengths: pa.Array, name: str) -> pa.Table:
    """Per token: its text and the byte where it ends in it as one key, its id and its place among all tokens."""
    flat, text = pc.list_flatten(ids), pc.list_parent_indices(ids)
    total = np.concatenate([[0], pc.cumulative_sum(lengths.take(flat)).to_numpy()])
    start = pa.array(total[ids.offsets.to_numpy()[:-1]])
    end = pc.subtract(pa.array(total[1:]), start.take(text))
    return pa.table({"key": pc.add(pc.shift_left(text.cast(pa.int64()), END_BITS), end), name: flat, f"{name}_at": np.arange(len(flat), dtype=np.int32)})


def _joined(ids: pa.ListArray, names: pa.Array, cuts: np.ndarray) -> pa.Array:
    """Ids of each group, joined by commas; ``cuts``: where groups end."""
    offsets = pa.array(np.concatenate([[0], cuts]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, names.take(pc.list_flatten(ids))), ",")


def _names(n: int) -> pa.Array:
    return pa.array(np.arange(n)).cast(pa.string())


def align_texts(texts: list[str], a: ByteLevel, b: Pieces, a_names: pa.Array, b_names: pa.Array) -> tuple[list[tuple[int, int, int, str] | None], pa.Table]:
    """Of texts that begin with a space: n_a, n_b, n_groups and the groups' string, or None if the tokens don't give the text back;
    and a table of (text, a, b, n), how often each pair of ids ends together in each text."""
    ids_a, ids_b = (c.known.lists([c.words(t) for t in texts], c.encode) for c in (a, b))
    plain = pa.array([t.encode() for t in texts], pa.binary())
    right = pc.and_(pc.equal(_bytes(ids_a, a.bytes), plain), pc.equal(_bytes(ids_b, b.bytes), plain))
    which = np.flatnonzero(right.to_numpy(zero_copy_only=False))
    ids_a, ids_b = (x.take(pa.array(which)) for x in (ids_a, ids_b))
    left, rest = (_ends(x, pc.binary_length(c.bytes).cast(pa.int64()), n) for x, c, n in ((ids_a, a, "a"), (ids_b, b, "b")))
    ends = left.join(rest, "key", join_type="inner", use_threads=False).sort_by("a_at").combine_chunks()
    ends = ends.append_column("text", pc.shift_right(ends["key"], END_BITS))
    groups = pc.binary_join_element_wise(*(_joined(x, names, ends[f"{n}_at"].to_numpy() + 1) for x, names, n in ((ids_a, a_names, "a"), (ids_b, b_names, "b"))), "|")
    per = np.bincount(ends["text"].to_numpy(), minlength=len(which)).astype(np.int64)
    strings = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per)]), pa.int32()), groups), ";").to_pylist()
    found: list = [None] * len(texts)
    for i, *row in zip(which.tolist(), pc.list_value_length(ids_a).to_pylist(), pc.list_value_length(ids_b).to_pylist(), per.tolist(), strings, strict=True):
        found[i] = tuple(row)
    pairs = ends.group_by(["text", "a", "b"], use_threads=False).aggregate([("key", "count")]).rename_columns(["text", "a", "b", "n"])
    return found, pairs.set_column(0, "text", pa.array(which, pa.int64()).take(pairs["text"].combine_chunks() if len(pairs) else pa.array([], pa.int64())))


_PLACE = regex.compile("(?<=[A-Za-z]) (?=[A-Za-z])")


def parts(text: str, size: int) -> list[str]:
    """A text in parts of about ``size`` characters, cut before a single space between two ASCII letters: both tokenizers end a token there."""
    cuts, at = [0], size
    while at < len(text) and (m := _PLACE.search(text, at)):
        cuts.append(m.start())
        at = m.start() + size
    return [text[i:j] for i, j in zip(cuts, [*cuts[1:], len(text)], strict=True)]


class _Row:
    """What is known of one row while its parts come in."""

    def __init__(self, n: int):
        self.left, self.right, self.counts, self.sha, self.pairs = n, True, [0, 0, 0], hashlib.sha256(), []

    def add(self, found: tuple | None, pairs: pa.Table) -> None:
        self.left -= 1
        self.right = self.right and found is not None
        if self.right:
            *counts, text = found
            self.sha.update((";" if self.counts[2] else "").encode() + text.encode())
            self.counts = [x + y for x, y in zip(self.counts, counts, strict=True)]
            self.pairs = [_sum(pa.concat_tables([*self.pairs, pairs]))] if self.pairs else [pairs]


def _sum(pairs: pa.Table, by: tuple[str, ...] = ("a", "b")) -> pa.Table:
    out = pairs.group_by(list(by), use_threads=False).aggregate([("n", "sum")])
    return out.rename_columns([*by, "n"])


def _rows(texts: Iterator[str | None], a: ByteLevel, b: Pieces, chunk: int = CHUNK, part_size: int = PART) -> Iterator[tuple[_Row, int]]:
    """The finished rows in order, each with its place."""
    a_names, b_names = _names(len(a.bytes)), _names(len(b.bytes))
    rows: dict[int, _Row] = {}
    held: list[tuple[int, str]] = []

    def flush() -> None:
        found, pairs = align_texts([t for _, t in held], a, b, a_names, b_names)
        pairs = pairs.sort_by("text")
        bounds = np.searchsorted(pairs["text"].to_numpy(), np.arange(len(held) + 1))
        pairs = pairs.select(["a", "b", "n"])
        for k, (i, _) in enumerate(held):
            rows[i].add(found[k], pairs.slice(bounds[k], bounds[k + 1] - bounds[k]))
        held.clear()

    size = done = 0
    for i, text in enumerate(texts):
        full = f" {text}" if text else ""
        cut = [full] if len(full) <= part_size or a.whole(full) or not b.cut else parts(full, part_size)
        rows[i] = _Row(len(cut) if full else 0)
        for part in cut if full else ():
            held.append((i, part))
            size += len(part)
            if size >= chunk:
                flush()
                size = 0
                while done in rows and not rows[done].left:
                    yield rows.pop(done), done
                    done += 1
    if held:
        flush()
    while done in rows:
        yield rows.pop(done), done
        done += 1


def align(df: DataFrame, a_path: str, b_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``a_path``: a byte-level BPE file, given a space and the text; ``b_path``: a sentencepiece model that adds the space
    itself. Groups are cut where tokens of both end; links are the pairs of tokens that end together, one for each group.
    ``count_sum`` adds up, over a row's links, how many links of all rows hold the same pair of ids; ``n_best``: links whose pair is the
    most frequent of its second id, ties included. The hash is of the groups' ids, ``a1,a2|b1;a3|b2,b3``.

    A text that is null or empty, or that either tokenizer does not give back byte for byte, has no tokens: zeros and an empty
    string. Rows are judged each, whatever their id (null ids are passed on); other columns are not looked at; no rows give no rows.
    Texts of over PART characters are aligned in parts. Texts are encoded once, what is needed of them is written: one pass over it
    counts pairs, a second looks them up.
    """
    spark = df.sparkSession
    kind = df.schema[id_col].dataType.simpleString()
    lists = pa.list_(pa.int32())
    chunk, part_size = CHUNK, PART

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _coders(a_path, b_path)
        for batch in batches:
            texts = (x.as_py() for x in batch.column(1))
            out: list = []
            size, first = 0, 0

            def record() -> pa.RecordBatch:
                tables = [r.pairs[0] if r.right and r.pairs else None for r in out]
                of = lambda c: pa.array([t[c].to_numpy() if t else [] for t in tables], lists)
                counts = np.array([r.counts if r.right else [0, 0, 0] for r in out], np.int64).reshape(-1, 3)
                sha = [r.sha.hexdigest() if r.right and r.counts[2] else "" for r in out]
                return pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(out)), *map(pa.array, counts.T), pa.array(sha, pa.string()), of("a"), of("b"), of("n")], names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "a", "b", "n"])

            for row, _ in _rows(texts, a, b, chunk, part_size):
                out.append(row)
                size += len(row.pairs[0]) if row.pairs else 0
                if size >= HELD:
                    yield record()
                    first, size, out = first + len(out), 0, []
            if out:
                yield record()

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = materialise(rows.mapInArrow(encode, f"doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, a array<int>, b array<int>, n array<int>"), "alignment")

    def flat(batch: pa.RecordBatch, *more: str) -> pa.Table:
        columns = {c: pc.list_flatten(batch.column(c)) for c in ("a", "b", "n")}
        return pa.table({"text": pc.list_parent_indices(batch.column("a")), **columns} if more else columns)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(_sum(flat(batch)))
            n += len(held[-1])
            if n >= HELD:
                held = [_sum(pa.concat_tables(held))]
                n = len(held[0])
                if n >= HELD // 2:  # many pairs: hand them over
                    yield from held[0].cast(counted).to_batches()
                    held, n = [], 0
        if held:
            yield from _sum(pa.concat_tables(held)).cast(counted).to_batches()

    counted = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])
    counts = found.select("a", "b", "n").mapInArrow(partial, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("count"))
    table = counts.toArrow()  # at most most_pairs() rows: pairs of which one is a suffix of the other
    if len(table) > most_pairs(a_path, b_path):
        raise AssertionError("more pairs than two vocabularies can have")
    top = table.group_by("b").aggregate([("count", "max")]).rename_columns(["b", "top"])
    table = table.join(top, "b", join_type="inner")
    best = pc.equal(table["count"], table["top"]).cast(pa.int64())
    shared = spark.sparkContext.broadcast(table.select(["a", "b", "count"]).append_column("best", best))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = flat(batch, "text").join(shared.value, ["a", "b"], join_type="inner", use_threads=False)
            n = links["n"].cast(pa.int64())
            sums = pa.table({"text": links["text"], "best": pc.multiply(n, links["best"]), "count": pc.multiply(n, links["count"])})
            sums = sums.group_by("text", use_threads=False).aggregate([("best", "sum"), ("count", "sum")])
            totals = np.zeros((2, batch.num_rows), np.int64)
            totals[:, sums["text"].to_numpy()] = sums["best_sum"].to_numpy(), sums["count_sum"].to_numpy()
            keep = batch.select(["doc_id", "n_a", "n_b", "n_groups"]).columns
            yield pa.RecordBatch.from_arrays([*keep, keep[3], *map(pa.array, totals), batch.column("groups_sha256")], names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return found.mapInArrow(look_up, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
