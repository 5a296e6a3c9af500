"""Removal of repeated passages by parsing against a reference, as in relative Lempel-Ziv, in phrases that the text itself delimits.

A word window is repeated if its words also start earlier in the corpus. Greedy factors, which start wherever the one before ended,
would be cut differently in every copy, and each document would have to be parsed against every block: work that grows with the
square of the corpus. So the dealt greedy factoring is replaced: each window of WINDOW words belongs to the least of its
GRAM-word hashes (its anchor), and a run of windows with one anchor is a phrase of 20 to 32 words. Phrases depend on their words
alone, so equal text is cut alike wherever it stands. The reference is the first place of every phrase; it is
indexed in blocks, which are the partitions of the shuffle by anchor, and every document meets every
block that can hold one of its phrases:

1. A phrase found earlier in its block is copied from there; neighbouring copied phrases join into one
   factor as long as phrases are copied. All windows inside a factor are repeated.
2. Where a factor ends, the next phrase is new but its anchor may be known with other words around
   it. Only there the windows are checked one by one, against all windows at such boundaries.

Phrases are told apart by the 64 bits of their anchor and 64 of their words, windows at boundaries by 128 bits of their words.
Rows that repeat inside a batch of BATCH bytes are merged before the shuffle, and anchors with very many phrases are dealt out by
phrase, so a key gathers one row for each batch at most, of 40 bytes, and these are only ranked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WordHashes, chunks, materialise, mix, tidy, windows

#: Words of an anchor; text bytes of a batch; phrases of one anchor in a batch from which it is dealt out.
GRAM, BATCH, CROWD = 8, 6 << 20, 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
# What a row says, in the two lowest bits of `place`; above them 6 bits of length (two unused), then the start.
PLAIN, KNOWN, SPAN = 0, 1, 2


class _Powers:
    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            ones = np.ones(max(n, 1 << 20), np.uint64)
            cls.up, cls.down = (np.cumprod(np.where(np.arange(len(ones)) > 0, b, ones), dtype=np.uint64) for b in (_BASE, _INVERSE))
        return cls.up, cls.down


def spans_of(hashes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of words (start, length)."""
    up, down = _Powers.of(len(hashes) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[: len(hashes)], dtype=np.uint64)])
    return mix((total[starts + lengths] - total[starts]) * down[starts] + lengths.astype(np.uint64) * _BASE)


def parse(hashes: np.ndarray, ends: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Phrases of documents that stand one after the other: document, first and last window start, anchor hash."""
    n = len(hashes) - window + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    grams = windows(hashes, GRAM)
    anchor = np.lib.stride_tricks.sliding_window_view(grams, window - GRAM + 1).argmin(axis=1) + np.arange(n)
    doc = np.searchsorted(ends, np.arange(n), side="right")
    valid = np.arange(n) + window <= ends[doc]
    new = np.ones(n, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | ~valid[:-1]
    first = np.flatnonzero(new & valid)
    stop = np.flatnonzero(np.concatenate([(new | ~valid)[1:], [True]]) & valid)
    return doc[first], first, stop, grams[anchor[first]]


def merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals [start, stop)."""
    if not len(starts):
        return starts, stops
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    head = np.concatenate([[True], starts[1:] > stops[:-1]])
    return starts[head], stops[np.concatenate([head[1:], [True]])]


def _read(texts: list[bytes], of: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of the texts, one after the other, and where each begins and ends."""
    split = [t.split() for t in texts]
    counts = np.array([len(w) for w in split], np.int64)
    ends = np.cumsum(counts)
    return of.of([w for words in split for w in words]), ends - counts, ends


def _place(starts, lengths, kind) -> np.ndarray:
    return (starts.astype(np.int64) << 16) | (lengths << 2) | kind


def _other(hashes: np.ndarray) -> np.ndarray:
    """Second hashes of words, for a second hash of windows."""
    return mix(hashes + np.uint64(0xD1B54A32D192ED03))


def _batches(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at, texts in chunks(b.column(text), BATCH):
            yield b.slice(at, len(texts))


def _documents(b: pa.RecordBatch) -> pa.RecordBatch:
    """A batch in the order of its documents, without rows of no id and with one row for each (id, tag)."""
    b = b.filter(b.column(0).is_valid())
    b = b.take(pc.sort_indices(b, [(b.schema.names[0], "ascending"), (b.schema.names[1], "ascending")]))
    if b.num_rows < 2:
        return b
    same = pc.and_(*(pc.equal(b.column(i).slice(1), b.column(i).slice(0, b.num_rows - 1)) for i in (0, 1)))
    return b.filter(pa.concat_arrays([pa.array([True]), pc.invert(same)]))


def _out(key, extra, b: pa.RecordBatch, rows, place) -> pa.RecordBatch:
    cast = lambda x: pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))
    at = pa.array(rows)
    return pa.RecordBatch.from_arrays([cast(key), cast(extra), b.column(0).take(at), b.column(1).take(at), cast(place)], names=["key", "extra", "doc_id", "tag", "place"])


def _given(df: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...]) -> DataFrame:
    """(doc_id, tag, text, ...): the tag counts the different texts of one id, in the order of a digest; nearly all are 0."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    given = df.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("digest"), text.cast("binary").alias("text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)])
    named = given.select("doc_id", "digest").filter("doc_id is not null")
    several = named.groupBy("doc_id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).filter("x <> y").select("doc_id")
    tags = named.join(several, "doc_id").distinct().withColumn("tag", F.row_number().over(Window.partitionBy("doc_id").orderBy("digest")) - 1)
    tags = materialise(tags, "tags")
    return given.join(tags, ["doc_id", "digest"], "left").select("doc_id", F.coalesce("tag", F.lit(0)).alias("tag"), "text", *given.columns[3:])


def remove_repeats(df: DataFrame, *, window: int = 20, id_col: str = "doc_id", text_col: str = "text", verbatim: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, spans (removed [start, stop) in words), kept (the other words, joined by one space), and the columns of ``carry``.

    Words are runs of bytes other than space and 0x09-0x0D. A word goes if it stands in a window of
    ``window`` words (20 to 39) that also starts earlier: in a smaller id, or earlier in the same document; windows
    are judged on the input. A null text has no words. Rows with a null id are kept whole and are no one's
    reference. Rows with equal id and text are one document and get equal results; rows with equal
    id and other text are ordered by a digest of the text. With ``verbatim``, ``kept`` is the text itself where no word goes.
    Columns that are not in ``carry``, whatever their names, are not looked at; no rows give no rows.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = df.schema[id_col].dataType.simpleString()
    # the texts are shuffled once; all three passes over them read the same exchange
    docs = _given(df, id_col, text_col, carry).repartition(n, "doc_id", "tag")

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()  # of this task alone
        for b in _batches(batches, 2):
            b = _documents(b)
            if not b.num_rows:
                continue
            hashes, begins, ends = _read(b.column(2).to_pylist(), words)
            doc, first, last, anchor = parse(hashes, ends, window)
            lengths = last - first + window
            phrase = spans_of(hashes, first, lengths) + anchor
            starts = first - begins[doc]
            # the first of each phrase in this batch goes on; all others are repeated already
            _, lead = np.unique(phrase, return_index=True)
            copy = np.ones(len(phrase), bool)
            copy[lead] = False
            wide = starts[copy] + (doc[copy] << 32)  # document and word in one number
            lo, hi = merged(wide, wide + lengths[copy])
            own = lo >> 32
            lead.sort()
            order = np.argsort(anchor[lead], kind="stable")
            sorted_ = anchor[lead][order]
            head = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(lead) else np.zeros(0, np.int64)
            size = np.diff(np.append(head, len(lead)))
            nth = np.empty(len(lead), np.int64)
            nth[order] = np.arange(len(lead)) - np.repeat(head, size)
            crowded = np.empty(len(lead), bool)
            crowded[order] = np.repeat(size > CROWD, size)
            known = crowded & (nth >= 2)
            key, extra = np.where(known, mix(phrase[lead] + np.uint64(1)), anchor[lead]), phrase[lead]
            if known.any():
                extra[known] = spans_of(_other(hashes), first[lead][known], lengths[lead][known])
            yield _out(key, extra, b, doc[lead], _place(starts[lead], lengths[lead], np.where(known, KNOWN, PLAIN)))
            yield _out(mix(lo.astype(np.uint64) + hashes[begins[own] + lo - (own << 32)]), hi - (own << 32), b, own, _place(lo - (own << 32), 0 * lo, SPAN))

    schema = f"key long, extra long, doc_id {kind}, tag int, place long"
    found = docs.select("doc_id", "tag", "text", *docs.columns[3:]).mapInArrow(tidy(phrases), schema).repartition(n, "key")
    says = F.col("place").bitwiseAND(3)
    of_phrase = Window.partitionBy("key", "extra").orderBy("doc_id", "tag", "place")
    of_anchor = Window.partitionBy("key")
    found = found.withColumn("nth", F.rank().over(of_phrase)).withColumn("others", F.min("extra").over(of_anchor) != F.max("extra").over(of_anchor))
    # a span as it is; a later copy as a span; the first of a phrase as boundary, where its anchor has other phrases
    start = F.shiftrightunsigned("place", 16)
    stop = start + F.shiftrightunsigned("place", 2).bitwiseAND(63)
    copied = (says == SPAN) | (F.col("nth") > 1)
    found = found.filter(copied | (says == KNOWN) | F.col("others")).select(
        "doc_id", "tag", F.struct(start.alias("start"), F.when(says == SPAN, F.col("extra")).otherwise(stop).alias("stop"), copied.alias("copied")).alias("s"),
    )
    of_doc = found.groupBy("doc_id", "tag").agg(F.collect_list("s").alias("s"))  # at most one for each place of a document

    def boundaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for b in _batches(batches, 2):
            b = _documents(b)
            s = b.column(3)
            flat = s.flatten()
            starts, stops, copied = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            own = np.repeat(np.arange(b.num_rows), np.diff(s.offsets.to_numpy()))
            wide = starts + (own << 32), stops + (own << 32)  # document and word in one number
            lo, hi = merged(wide[0][copied], wide[1][copied])
            # every window at a boundary: also one whose words all go may be where another document's window starts first
            texts = [t if k else b"" for t, k in zip(b.column(2).to_pylist(), np.bincount(own[~copied], minlength=b.num_rows) > 0, strict=True)]
            hashes, begins, _ = _read(texts, words)
            count = stops[~copied] - starts[~copied] - window + 1
            at = np.repeat(wide[0][~copied] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum()) if len(count) else np.zeros(0, np.int64)
            at = np.unique(at)
            doc, start = at >> 32, at & ((1 << 32) - 1)
            key = spans_of(hashes, begins[doc] + start, np.full(len(at), window))
            _, lead = np.unique(key, return_index=True)
            again = np.ones(len(at), bool)
            again[lead] = False
            extra = spans_of(_other(hashes), begins[doc[lead]] + start[lead], np.full(len(lead), window))
            yield _out(key[lead], extra, b, doc[lead], _place(start[lead], 0 * lead, PLAIN))
            lo, hi = merged(np.concatenate([lo, at[again]]), np.concatenate([hi, at[again] + window]))
            doc, start = lo >> 32, lo & ((1 << 32) - 1)
            yield _out(mix(lo.astype(np.uint64)), hi - (doc << 32), b, doc, _place(start, 0 * lo, SPAN))

    checked = docs.join(of_doc, ["doc_id", "tag"]).select("doc_id", "tag", "text", "s", *docs.columns[3:]).mapInArrow(tidy(boundaries), schema).repartition(n, "key")
    nth = F.rank().over(Window.partitionBy("key", "extra", says).orderBy("doc_id", "tag", "place"))
    gone = checked.withColumn("nth", nth).filter((says == SPAN) | (F.col("nth") > 1))
    gone = gone.select("doc_id", "tag", F.struct(start.alias("start"), F.when(says == SPAN, F.col("extra")).otherwise(start + window).alias("stop")).alias("s"))
    gone = gone.groupBy("doc_id", "tag").agg(F.collect_list("s").alias("s"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _batches(batches, 2):
            words, removed, spans, kept = [], [], [], []
            for t, s in zip(b.column(2).to_pylist(), b.column(3), strict=True):
                w = t.split()
                words.append(len(w))
                if not s.is_valid:
                    removed.append(0)
                    spans.append([])
                    kept.append(t if verbatim else b" ".join(w))
                    continue
                lo, hi = merged(*(s.values.field(i).to_numpy() for i in range(2)))
                removed.append(int((hi - lo).sum()))
                spans.append([{"start": x, "stop": y} for x, y in zip(lo.tolist(), hi.tolist(), strict=True)])
                left = zip([0, *hi.tolist()], [*lo.tolist(), len(w)], strict=True)
                kept.append(b" ".join([x for i, j in left for x in w[i:j]]))
            pair = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pair), pa.array(kept, pa.binary()).cast(pa.string()), *b.columns[4:]], names=["doc_id", "n_words", "n_removed", "spans", "kept", *b.schema.names[4:]])

    more = "".join(f", c{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(carry))
    last = docs.join(gone, ["doc_id", "tag"], "left").select("doc_id", "tag", "text", "s", *docs.columns[3:])
    last = last.mapInArrow(tidy(keep), f"doc_id {kind}, n_words long, n_removed long, spans array<struct<start:bigint,stop:bigint>>, kept string{more}")
    return last.select("doc_id", "n_words", "n_removed", "spans", "kept", *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)])
