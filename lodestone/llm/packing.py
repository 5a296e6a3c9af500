"""Best-fit packing of tokenised documents into sequences of fixed length.

`pieces` tokenises whole documents and cuts only those longer than a sequence. `pack` deals the
pieces into packing groups of a bounded number of rows, each packed by one online best-fit with a
fixed number of open bins: a bitset over free space finds the fullest bin that still takes the piece
in one step; when a bin must be opened and all are in use, the fullest is closed first. In a group
pieces arrive in runs, longest first in each, so that short ones fill the gaps that long ones leave.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, materialise, tidy

#: Pieces a packing group holds on average, pieces of a run, and bins open at a time in a group. On the generated documents a group
#: then closes some 2,500 bins by the rule, and its sequences are 0.03 % more than their tokens need at least.
GROUP_ROWS, RUN, OPEN_BINS = 32_768, 2048, 1024
#: Copies of one row from which they are dealt out each for itself.
SAME = 256
#: Words longer than this are encoded anew each time. Of shorter ones two generations of GENERATION are remembered.
LONGEST, GENERATION = 48, 120_000
#: Bytes of text that are cut into words at a time.
CHUNK = 4 << 20

# The parts of a tokenizer file for which texts may be cut at words.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
END_OF_WORD = "</w>"

# Kinds of bytes, for the places at which texts may be cut; others are never cut at. An apostrophe may begin a contraction.
SPACE, LETTER, DIGIT, MARK, APOSTROPHE = 1, 2, 3, 4, 5
KIND = np.zeros(256, np.uint8)
KIND[33:127] = MARK
KIND[[*range(9, 14), 32]] = SPACE
KIND[[*b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = LETTER
KIND[[*b"0123456789"]] = DIGIT
KIND[ord("'")] = APOSTROPHE


def cut_words(texts: list[bytes], *, finely: bool = True) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, and up to which of them each text's go.

    Words are cut at white space; ``finely``, also where of two ASCII characters (or a letter of Latin-1 and an ASCII character) one is a letter, digit or mark and the
    other of another of these kinds, between digits, and not after an apostrophe; and their letters up to U+00DE are lower-cased, but for one that a
    combining character follows: with it the small letter may have a character of its own where the capital has none.
    """
    data = np.frombuffer(b" ".join(texts), np.uint8).copy()
    kind = KIND[data]
    start = np.empty(len(data), bool)
    start[:1] = True
    np.equal(kind[:-1], SPACE, out=start[1:])
    if finely:
        lead = np.flatnonzero(data == 0xC3)  # U+00C0 to U+00FF, without the two signs among them
        latin = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)] + 1
        kind[latin] = LETTER
        upper = np.concatenate([np.flatnonzero((data >= 65) & (data <= 90)), latin[data[latin] <= 0x9E]])
        after = data[np.minimum(upper + 1, len(data) - 1)]
        data[upper[(after != 0xCC) & (after != 0xCD)]] += 32
        a, b = kind[:-1], kind[1:]
        start[1:] |= ((a == LETTER) | (a == DIGIT)) & (b > LETTER)
        start[1:] |= ((a == MARK) | (a == DIGIT)) & ((b == LETTER) | (b == DIGIT))
    inside = kind != SPACE
    start &= inside
    upto = np.searchsorted(np.flatnonzero(start), np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1))
    body = data[inside]
    bounds = np.append(np.flatnonzero(start[inside]), len(body)).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(body)]), upto


class WordIds:
    """The ids (little-endian uint32 bytes) of whole texts, remembered by word where the tokenizer file allows that.

    It does if its normalizer and pre-tokenizer are those above, it adds no tokens around a text, and all added tokens' strings hold
    a ``<``. Then texts are cut by `cut_words`: no token reaches across such a cut, and no character of Unicode is composed across; each distinct word of a
    chunk of texts is looked up or encoded once. Texts with ``<`` are cut at white space only and not
    lower-cased, since that could make an added token of another string. With any other file whole texts are encoded.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, added = spec["model"], spec.get("added_tokens") or []
        self.by_word = (
            (spec.get("normalizer"), spec.get("pre_tokenizer"), spec.get("post_processor")) == (NORMALIZER, PRE_TOKENIZER, None)
            and model.get("type") == "BPE" and not model.get("dropout")
            and all("<" in a["content"] and not re.search(r"\s", a["content"]) and not (a.get("lstrip") or a.get("rstrip") or a.get("single_word")) for a in added)
        )
        #: Ids that end a word: with them the ids of many words can be told apart.
        self.last = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        if model.get("end_of_word_suffix") == END_OF_WORD:
            self.last[[i for t, i in model["vocab"].items() if t.endswith(END_OF_WORD)]] = True
        self.letters = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+").fullmatch  # one pre-token each, which the normalizer leaves as it is
        if self.by_word:
            from tokenizers import Tokenizer, pre_tokenizers

            self.plain = Tokenizer(self.tokenizer.model)
            self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _encode(self, texts: list[bytes], tokenizer=None) -> list[list[int]]:
        return [e.ids for e in (tokenizer or self.tokenizer).encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]

    def _words(self, new: list[bytes]) -> dict[bytes, bytes]:
        """The ids of each of ``new``; words of letters alone go through the tokenizer's merges many at a time."""
        plain, other = [], []
        for w in new:
            (plain if self.letters(w) else other).append(w)
        joined = [b" ".join(plain[i : i + 256]) for i in range(0, len(plain), 256)]
        found = [np.array(x, "<u4") for i in range(0, len(joined), 32) for x in self._encode(joined[i : i + 32], self.plain)]  # the library's own records of tokens are large
        ids = np.concatenate(found) if found else np.zeros(0, "<u4")
        stops = (np.flatnonzero(self.last[ids]) + 1) * 4
        made = {}
        if len(stops) == len(plain):
            data = ids.tobytes()
            bounds = [0, *stops.tolist()]
            made = {w: data[a:b] for w, a, b in zip(plain, bounds, bounds[1:], strict=False)}
        else:  # no word ends to go by
            other = new
        made.update((w, np.array(x, "<u4").tobytes()) for w, x in zip(other, self._encode(other), strict=True))
        return made

    def _ids(self, texts: list[bytes], finely: bool) -> list[bytes]:
        words, upto = cut_words(texts, finely=finely)
        words = words.dictionary_encode()
        distinct = words.dictionary.to_pylist()
        if len(self.known) > GENERATION:  # frequent words come back from the older half
            self.known, self.older = {}, self.known
        ids = list(map(self.known.get, distinct))
        missing = [i for i, x in enumerate(ids) if x is None]
        again = list(map(self.older.get, map(distinct.__getitem__, missing)))
        made = self._words([distinct[i] for i, x in zip(missing, again, strict=True) if x is None])
        for i, x in zip(missing, again, strict=True):
            w = distinct[i]
            ids[i] = made[w] if x is None else x
            if len(w) <= LONGEST:
                self.known[w] = ids[i]
        all_ids = pa.array(ids, pa.large_binary()).take(words.indices)
        _, bounds, data = all_ids.buffers()
        if not len(words):
            return [b""] * len(texts)
        ends = np.frombuffer(bounds, np.int64)[all_ids.offset + upto].tolist()
        return [data[a:b].to_pybytes() for a, b in zip([0, *ends], ends, strict=False)]

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_word:
            return [np.array(x, "<u4").tobytes() for x in self._encode(texts)]
        odd = [b"<" in text for text in texts]
        if not any(odd):
            return self._ids(texts, True)
        done = {some: iter(self._ids([t for t, x in zip(texts, odd, strict=True) if x == some], not some)) for some in (False, True)}
        return [next(done[x]) for x in odd]


_words: dict[str, WordIds] = {}


def pieces(df: DataFrame, path: str, *, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, piece (from 0), start, length, ids (little-endian uint32 bytes).

    A document is its text's ids and then ``end_id``; only a longer one than ``capacity`` is cut.
    ``path``: a tokenizers file; see `WordIds` for those whose words are remembered. A null text counts as empty
    (one piece with the end id alone); repeated rows and rows of no id give pieces each; very long texts are encoded whole. Other columns,
    whatever their names, are not looked at; no rows give no pieces.
    """
    kind = df.schema[id_col].dataType.simpleString()
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _words:
            _words[path] = WordIds(path)
        encode, step, schema = _words[path], 4 * capacity, None
        try:
            for b in batches:
                schema = schema or pa.schema([b.schema.field(0), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])
                for lo, texts in chunks(b.column(1), CHUNK):
                    owner, number, start, ids = [], [], [], []
                    for i, all_ids in enumerate(encode(texts), lo):
                        all_ids += end
                        for k, at in enumerate(range(0, len(all_ids), step)):
                            owner.append(i)
                            number.append(k)
                            start.append(at // 4)
                            ids.append(all_ids[at : at + step])
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(owner, pa.int32())), pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], schema=schema)
        finally:
            encode.forget()

    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(tidy(run), f"doc_id {kind}, piece int, start long, length long, ids binary")


def best_fit(lengths: list[int], capacity: int, open_bins: int) -> tuple[list[int], list[int]]:
    """The bin and the offset of each length, taken in the given order."""
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    free = 0  # bit f is set while an open bin has f places free
    bins, offsets, made, used = [], [], 0, 0
    for n in lengths:
        fits = free >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            k = by_free[room].pop()
            if not by_free[room]:
                free &= ~(1 << room)
        else:
            if used == open_bins:  # close the fullest
                full = (free & -free).bit_length() - 1
                by_free[full].pop()
                if not by_free[full]:
                    free &= ~(1 << full)
                used -= 1
            room, k = capacity, made
            made += 1
            used += 1
        bins.append(k)
        offsets.append(capacity - room)
        if room > n:
            by_free[room - n].append(k)
            free |= 1 << (room - n)
        else:
            used -= 1
    return bins, offsets


def pack(rows: DataFrame, *, capacity: int = 2048, open_bins: int = OPEN_BINS, run_rows: int = RUN, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``rows`` (doc_id, piece, length and any others but sequence_id, offset) with sequence_id and offset added.

    Every row is placed once; offsets in a sequence are gapless from 0. A length over ``capacity``, below 1 or
    null is an error. Rows are dealt into groups by a digest; of a row that stands there more than SAME times each copy gets a number of its
    own instead. Digests are written to the shared folder with the rows, so a retried task packs the same ones. No rows give no rows.
    """
    given = rows.columns
    rows = materialise(rows.withColumn("__deal", F.xxhash64(*given)), "pieces")
    often = rows.groupBy("__deal").agg(F.count("*").alias("__times")).filter(F.col("__times") > SAME)
    if not often.isEmpty():
        own = F.when(F.col("__times").isNotNull(), F.xxhash64("__deal", F.monotonically_increasing_id())).otherwise(F.col("__deal"))
        rows = materialise(rows.join(often, "__deal", "left").withColumn("__deal", own).drop("__times"), "pieces")
    groups = max(1, -(-rows.count() // group_rows))
    others = [c for c in given if c != "length"]
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in ["length", *others])
    grouped = rows.withColumn("__group", F.pmod("__deal", F.lit(groups)).cast("int"))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        if not pdf["length"].between(1, capacity).all():
            raise ValueError(f"a piece's length is not from 1 to {capacity}")
        pdf = pdf.sort_values(["__deal", *others], kind="stable")
        pdf = pdf.iloc[np.lexsort((-pdf["length"].to_numpy(), np.arange(len(pdf)) // run_rows))]
        bins, offsets = best_fit(pdf["length"].tolist(), capacity, open_bins)
        pdf = pdf[["length", *others]].assign(sequence_id=(int(key[0]) << 40) + np.array(bins, np.int64), offset=np.array(offsets, np.int64))
        return pdf

    return grouped.groupBy("__group").applyInPandas(run, f"{schema}, sequence_id long, offset long").select(*given, "sequence_id", "offset")


def sequences(placed: DataFrame) -> DataFrame:
    """The sequences themselves: sequence_id, n_tokens, ids (bytes), doc_ids, from rows of `pack` that kept ``ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "ids")))  # at most ``capacity`` pieces
    s = placed.groupBy("sequence_id").agg(parts.alias("p"))
    ids = F.aggregate("p.ids", F.lit("").cast("binary"), lambda a, x: F.concat(a, x))
    return s.select("sequence_id", F.aggregate("p.length", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_tokens"), ids.alias("ids"), F.col("p.doc_id").alias("doc_ids"))
