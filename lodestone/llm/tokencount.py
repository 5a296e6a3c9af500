"""Token counts with the whole-token shortcut.

Offline, every string of the vocabulary that the tokenizer encodes, alone, as one pre-token and one
token is proven to be such (`whole_tokens`). In the tasks each text is cut into pre-tokens; those in
the proven table count one, only the rest goes through the tokenizer's merges. Results equal the
tokenizer's own counts.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks

# Fixed value: the byte-level pre-tokenizer's split pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens longer than this are merged anew each time; shorter ones are remembered, up to MEMORY of them.
LONGEST, MEMORY = 48, 300_000


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(maxsize=4)
def _special(path: str) -> tuple[str, ...]:
    """Strings that the tokenizer cuts out of a text before it splits the rest, longest first."""
    return tuple(sorted((t.content for t in _tokenizer(path).get_added_tokens_decoder().values()), key=len, reverse=True))


@lru_cache(maxsize=1)
def unassigned() -> frozenset[str]:
    """The characters that this Python's Unicode tables don't hold.

    The library and the regex module may know different versions of Unicode and so class newer characters
    differently; a text with such a character goes to the library whole. That they agree on all others is tested.
    """
    return frozenset(c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn")


def whole_tokens(path: str) -> list[str]:
    """The vocabulary strings proven to be one pre-token and one token when encoded alone."""
    t, split = _tokenizer(path), regex.compile(PATTERN)
    strings = {s for i in range(t.get_vocab_size()) if (s := t.decode([i], skip_special_tokens=False)) and "�" not in s}
    strings -= set(_special(path))
    alone = sorted(s for s in strings if split.fullmatch(s) and split.match(s).end() == len(s))
    return [s for s, e in zip(alone, t.encode_batch(alone, add_special_tokens=False), strict=True) if len(e.ids) == 1]


class Counter:
    """Counts tokens of batches of texts; remembers what the tokenizer made of pre-tokens that are not whole tokens."""

    def __init__(self, path: str, whole: list[str]):
        self.tokenizer, self.special, self.whole = _tokenizer(path), _special(path), whole
        self.findall = regex.compile(PATTERN).findall
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.odd = unassigned()
        self.forget()

    def forget(self) -> None:
        self.known = dict.fromkeys(self.whole, 1)

    def _merge(self, pieces: list[str]) -> dict[str, int]:
        return dict(zip(pieces, map(len, self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)), strict=True))

    def __call__(self, texts: list[str]) -> list[int]:
        base, cut = [0] * len(texts), []
        for i, text in enumerate(texts):
            if not text.isascii() and not self.odd.isdisjoint(set(text)):
                base[i] = len(self.tokenizer.encode(text, add_special_tokens=False).ids)
                cut.append([])
            elif any(s in text for s in self.special):
                parts = self.cut.split(text)
                base[i] = len(parts) - 1
                cut.append([t for x in parts for t in self.findall(x)])
            else:
                cut.append(self.findall(text))
        if len(self.known) > len(self.whole) + MEMORY:
            self.forget()
        new = self._merge(list(set().union(*cut).difference(self.known)))
        self.known.update((k, n) for k, n in new.items() if len(k) <= LONGEST)
        long = {k: n for k, n in new.items() if len(k) > LONGEST}
        one = {**self.known, **long}.__getitem__ if long else self.known.__getitem__
        return [n + sum(map(one, c)) for n, c in zip(base, cut, strict=True)]


_counters: dict = {}


def count_tokens(df: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    ``path``: a byte-level BPE file of the tokenizers library, present on every executor. A null text
    counts as empty (0 bytes, 0 tokens); a null id is passed on; repeated rows are counted each;
    other columns are not looked at. One pass over the text, no shuffle.
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(whole_tokens(path))  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _counters:
            _counters[path] = Counter(path, shared.value)
        count = _counters[path]
        try:
            for b in batches:
                n = [k for _, texts in chunks(b.column(2)) for k in count(texts)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])
        finally:
            count.forget()

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
