"""Benchmark decontamination with an FM-index over each shard of the training text.

A shard is a run of documents of about SHARD bytes. Its words become numbers (words no benchmark item
holds: 0), and the stretches long enough to hold a test phrase are indexed: suffix array, its
Burrows-Wheeler transform in a wavelet matrix, and every SAMPLE-th suffix position. All test phrases
are searched backwards at once by rank queries; occurrences are located by walking to a sampled
position, and merged to spans of words. Nothing but the phrases leaves the driver, and no text is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, materialise, tidy

#: Bytes of text in a shard; sampling distance of suffix positions; benchmark bytes in one pass (broadcast).
SHARD, SAMPLE, BLOCK = 4 << 20, 8, 16 << 20

# A-Z are lower-cased, other ASCII but 0-9 and a-z parts words, bytes from 0x80 belong to words.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Order of all suffixes of ``s``, whose last symbol is its only least one (prefix doubling on the groups still tied)."""
    n = len(s)
    sa = np.argsort(s, kind="stable")
    head = np.concatenate([[True], s[sa][1:] != s[sa][:-1]])
    first = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[sa] = first
    tied = np.flatnonzero(~(head & np.concatenate([head[1:], [True]])))
    k = 1
    while len(tied):
        at = sa[tied]
        key = rank[at] * (n + 1) + rank[np.minimum(at + k, n - 1)]
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        sa[tied] = at
        head = np.concatenate([[True], key[1:] != key[:-1]])
        rank[at] = np.maximum.accumulate(np.where(head, tied, 0))
        tied = tied[~(head & np.concatenate([head[1:], [True]]))]
        k *= 2
    return sa


class FMIndex:
    """Over symbols 0 (only at the end), 1 (between stretches) and words from 2."""

    def __init__(self, s: np.ndarray, symbols: int):
        n = len(s)
        sa = suffix_array(s)
        self.n, self.levels = n, max(1, int(symbols - 1).bit_length())
        self.before = np.concatenate([[0], np.cumsum(np.bincount(s, minlength=symbols))])
        marked = sa % SAMPLE == 0
        self.marked, self.sampled = marked, sa[marked]
        self.nth = np.cumsum(marked) - 1
        last = s[sa - 1]
        self.zeros, self.ranks, self.bits = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (last >> level) & 1
            ones = np.concatenate([[0], np.cumsum(bit)])
            self.bits.append(bit.astype(bool))
            self.ranks.append(ones)
            self.zeros.append(n - int(ones[-1]))
            last = np.concatenate([last[bit == 0], last[bit == 1]])
        self.base = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, (ones, zeros) in enumerate(zip(self.ranks, self.zeros, strict=True)):
            one = ones[i]
            i = np.where((symbol >> (self.levels - 1 - k)) & 1, zeros + one, i - one)
        return i

    def step(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Backward step: rows before ``symbol`` + the suffixes before row ``i``."""
        return self.before[symbol] + self._down(symbol, i) - self.base[symbol]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [lo, hi) of the suffixes that start with each phrase (a row of symbols, padded on the right)."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n)
        for t in range(int(lengths.max(initial=0))):
            on = np.flatnonzero((t < lengths) & (lo < hi))
            c = phrases[on, lengths[on] - 1 - t]
            lo[on], hi[on] = self.step(c, lo[on]), self.step(c, hi[on])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes, by steps back to a sampled one."""
        at, steps = rows.copy(), np.zeros(len(rows), np.int64)
        while len(on := np.flatnonzero(~self.marked[at])):
            i, symbol = at[on], np.zeros(len(on), np.int64)
            for k, (ones, zeros) in enumerate(zip(self.ranks, self.zeros, strict=True)):
                bit = self.bits[k][i]
                symbol |= bit.astype(np.int64) << (self.levels - 1 - k)
                i = np.where(bit, zeros + ones[i], i - ones[i])
            at[on] = self.before[symbol] + i - self.base[symbol]
            steps[on] += 1
        return self.sampled[self.nth[at]] + steps


class Phrases:
    """The distinct windows of benchmark items, and of which items each is one."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.items = sorted({i for i, _ in items})
        number = {x: k for k, x in enumerate(self.items)}
        found: dict[tuple, set[int]] = {}
        for item, text in items:
            w = words(text)
            for at in range(max(1, len(w) - window + 1) if w else 0):
                found.setdefault(tuple(w[at : at + window]), set()).add(number[item])
        self.vocabulary = {w: k + 2 for k, w in enumerate(sorted({w for p in found for w in p}))}
        self.lengths = np.array([len(p) for p in found], np.int64)
        self.matrix = np.zeros((len(found), window), np.int64)
        for k, p in enumerate(found):
            self.matrix[k, : len(p)] = [self.vocabulary[w] for w in p]
        self.of = [sorted(x) for x in found.values()]
        self.shortest = int(self.lengths.min(initial=window))

    def find(self, texts: list[bytes]) -> tuple[list[int], list[list[tuple[int, int]]], list[set[int]]]:
        """Of each text of a shard: its words, merged spans of hit words, and the items with an occurrence."""
        split = [words(t) for t in texts]
        counts = [len(w) for w in split]
        spans: list = [[] for _ in texts]
        items: list = [set() for _ in texts]
        stop = b" "  # no word
        ids = np.fromiter(map(self.vocabulary.get, [w for ws in split for w in (*ws, stop)], repeat(0)), np.int64, sum(counts) + len(texts))
        known = ids > 0
        edge = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
        begin, end = edge[::2], edge[1::2]
        long = end - begin >= self.shortest
        begin, end = begin[long], end[long]  # with the place after each stretch, which holds no known word
        if not len(begin) or not len(self.of):
            return counts, spans, items
        size = end + 1 - begin
        place = np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        s = np.append(np.maximum(ids[place], 1), 0)
        index = FMIndex(s, len(self.vocabulary) + 2)
        there = np.bincount(s, minlength=len(self.vocabulary) + 2) > 0
        there[0] = True  # padding
        maybe = np.flatnonzero(there[self.matrix].all(axis=1))
        lo, hi = index.search(self.matrix[maybe], self.lengths[maybe])
        times = hi - lo
        rows = np.repeat(lo - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum())
        phrase = np.repeat(maybe, times)
        start = place[index.locate(rows)]
        first = np.cumsum([0, *(c + 1 for c in counts)])
        doc = np.searchsorted(first, start, side="right") - 1
        order = np.argsort(start, kind="stable")
        for d, p, at in zip(doc[order].tolist(), phrase[order].tolist(), (start - first[doc])[order].tolist(), strict=True):
            stop_ = at + int(self.lengths[p])
            if spans[d] and at <= spans[d][-1][1]:
                spans[d][-1] = spans[d][-1][0], max(spans[d][-1][1], stop_)
            else:
                spans[d].append((at, stop_))
            items[d].update(self.of[p])
        return counts, spans, items


def _merge(a: list, b: list) -> list:
    out: list = []
    for lo, hi in sorted([*a, *b]):
        if out and lo <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], hi)
        else:
            out.append((lo, hi))
    return out


def find_contamination(df: DataFrame, benchmark: DataFrame, *, window: int = 13, share: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, spans (hit [start, stop) in words), items (sorted as strings), contaminated (n_hit > 0 and share * n_hit >= n_words), and ``carry``.

    An item's phrases are its ``window`` consecutive words, or all of fewer. A null text has no words; items of no id
    or no words are left out; items with one id count as one. Rows are judged each, whatever their id (a null one is passed on). Columns that are
    not in ``carry`` are not looked at; no rows give no rows, no items hit nothing.
    A benchmark of more than BLOCK bytes is searched in blocks, one pass over the rows for each, which are written in between.
    """
    spark = df.sparkSession
    id_kind = df.schema[id_col].dataType.simpleString()
    more = "".join(f", c{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(carry))
    rows = df.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
        F.lit(0).cast("long").alias("n_words"), F.expr("cast(array() as array<struct<start:bigint,stop:bigint>>)").alias("spans"), F.expr("cast(array() as array<string>)").alias("items"),
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)],
    )
    schema = f"doc_id {id_kind}, text binary, n_words long, spans array<struct<start:bigint,stop:bigint>>, items array<string>{more}"
    tests = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("binary").alias("text")).dropna()
    size = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK))
    for k in range(blocks):
        block = tests if blocks == 1 else tests.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k)
        shared = spark.sparkContext.broadcast(Phrases([(r.item, bytes(r.text)) for r in block.toLocalIterator()], window))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            phrases = shared.value
            for whole in batches:
                for at, texts in chunks(whole.column(1), SHARD):
                    b = whole.slice(at, len(texts))
                    counts, spans, items = phrases.find(texts)
                    spans = [_merge([(x["start"], x["stop"]) for x in old], new) if old else new for old, new in zip(b.column(3).to_pylist(), spans, strict=True)]
                    items = [sorted({*old, *(phrases.items[i] for i in new)}) for old, new in zip(b.column(4).to_pylist(), items, strict=True)]
                    pairs = pa.array([[{"start": x, "stop": y} for x, y in s] for s in spans], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))
                    yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(counts, pa.int64()), pairs, pa.array(items, pa.list_(pa.string())), *b.columns[5:]], names=b.schema.names)

        rows = rows.mapInArrow(tidy(run), schema)
        if blocks > 1:
            rows = materialise(rows, "decontaminate")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    rows = rows.withColumn("n_hit", hit)
    return rows.select("doc_id", "n_words", "n_hit", "spans", "items", ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)])
