"""Ranked lexical search by a frequency-ordered prefix tree of documents.

Each document is kept as the vector of the queries' terms in it, most frequent term first. Documents whose vectors begin alike share
a path of the tree; a node knows, for all documents below it, the largest count of each term and the smallest length figure
``m``. Their score can be no higher than that of a document with these figures, so a depth-first search in the
order of these bounds leaves out every node that can't reach an item's best rows so far. The result is exact.

Each task builds trees over its own documents, of a bounded number of terms each, and keeps the best rows of each item from
tree to tree; Spark merges what the tasks found.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Bytes of query texts searched in one pass over the documents.
BLOCK = 4 << 20
#: Term counts that one tree holds, and documents that a leaf holds.
TREE, LEAF = 400_000, 32

# Fixed value: what bytes become before a text is split at spaces: A-Z lower case, other ASCII but 0-9 and a-z a space.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Queries:
    """Items with their terms as numbers of a common vocabulary."""

    def __init__(self, items: list[tuple[object, bytes]]):
        of: dict = {}
        for item, text in items:
            of.setdefault(item, set()).update(terms(text))
        self.items = [i for i, t in of.items() if t]
        self.vocabulary = {t: k for k, t in enumerate(sorted(set().union(*of.values())))}
        self.terms = [np.array(sorted(self.vocabulary[t] for t in of[i]), np.int64) for i in self.items]


def part_score(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds to a score, in 64-bit integers."""
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class Tree:
    """Documents with their terms, given as ranks by frequency (0 the most frequent), counts and ``m``."""

    def __init__(self, rank: list[np.ndarray], tf: list[np.ndarray], m: np.ndarray):
        within = [np.argsort(r) for r in rank]
        paths = [tuple(r[o].tolist()) for r, o in zip(rank, within, strict=True)]
        order = sorted(range(len(paths)), key=paths.__getitem__)
        self.order, self.m = np.array(order, np.int64), m[order]
        size = np.array([len(paths[i]) for i in order], np.int64)
        self.at = np.concatenate([[0], np.cumsum(size)])
        self.rank = np.concatenate([rank[i][within[i]] for i in order]) if order else np.zeros(0, np.int64)
        self.tf = np.concatenate([tf[i][within[i]] for i in order]) if order else np.zeros(0, np.int64)
        shared = np.zeros(len(order), np.int64)  # with the document before
        for i in range(1, len(order)):
            a, b = paths[order[i - 1]], paths[order[i]]
            n = min(len(a), len(b))
            shared[i] = next((k for k in range(n) if a[k] != b[k]), n)
        self.low, self.high, self.first, self.last = [0], [len(order)], [0], [0]  # documents and children of each node
        node = 0
        while node < len(self.low):
            lo, hi = self.low[node], self.high[node]
            kids = self._children(shared, lo, hi) if hi - lo > LEAF else []
            self.first[node], self.last[node] = len(self.low), len(self.low) + len(kids)
            for a, b in kids:
                self.low.append(a)
                self.high.append(b)
                self.first.append(0)
                self.last.append(0)
            node += 1
        self._bounds()

    @staticmethod
    def _children(shared: np.ndarray, lo: int, hi: int) -> list[tuple[int, int]]:
        """Where the path of documents [lo, hi) forks. A fork that more than half of them go on from is no node of its own, so that
        the depth is bounded by the logarithm of the documents; neighbours that fit one leaf are one."""
        cuts, a, b = {lo, hi}, lo, hi
        while b - a > max(LEAF, (hi - lo) // 2):
            depths = shared[a + 1 : b]
            inner = [a, *(np.flatnonzero(depths == depths.min()) + a + 1).tolist(), b]
            cuts.update(inner)
            a, b = max(zip(inner, inner[1:], strict=False), key=lambda x: x[1] - x[0])
        out: list[tuple[int, int]] = []
        marks = sorted(cuts)
        for a, b in zip(marks, marks[1:], strict=False):
            if out and b - out[-1][0] <= LEAF:
                out[-1] = out[-1][0], b
            else:
                out.append((a, b))
        return out

    def _bounds(self) -> None:
        """Of every node but the root: the terms below it with their largest counts, and the smallest ``m``."""
        ranks, most, ends, least = [], [], [0, 0], [0]
        for lo, hi in zip(self.low[1:], self.high[1:], strict=True):
            r, t = self.rank[self.at[lo] : self.at[hi]], self.tf[self.at[lo] : self.at[hi]]
            order = np.argsort(r, kind="stable")
            r, t = r[order], t[order]
            new = np.flatnonzero(np.diff(r, prepend=-1))
            ranks.append(r[new])
            most.append(np.maximum.reduceat(t, new) if len(new) else t)
            ends.append(ends[-1] + len(new))
            least.append(self.m[lo:hi].min())
        join = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        self.node_at, self.node_rank, self.node_most, self.node_m = np.array(ends), join(ranks), join(most), np.array(least)

    def search(self, weight: np.ndarray, best: list, count: int, ids: list) -> list:
        """The ``count`` best (-score, no id, id) of ``best`` and this tree's documents. ``weight``: of each rank, 0 where the item lacks the term."""
        stack = [(0, None)]
        while stack:
            node, bound = stack.pop()
            if bound is not None and (bound <= 0 or len(best) == count and bound < -best[-1][0]):
                continue
            if self.first[node] == self.last[node]:
                lo, hi = self.low[node], self.high[node]
                score = self._sums(weight, self.at, self.rank, self.tf, self.m, lo, hi)
                least = max(1, -best[-1][0]) if len(best) == count else 1
                found = [(-int(score[i]), ids[self.order[lo + i]] is None, ids[self.order[lo + i]]) for i in np.flatnonzero(score >= least)]
                if found:
                    best = heapq.nsmallest(count, best + found, key=lambda x: x[: 2 if x[1] else 3])
                continue
            a, b = self.first[node], self.last[node]
            bounds = self._sums(weight, self.node_at, self.node_rank, self.node_most, self.node_m, a, b)
            stack += [(int(i) + a, int(bounds[i])) for i in np.argsort(bounds, kind="stable")]
        return best

    @staticmethod
    def _sums(weight: np.ndarray, at: np.ndarray, rank: np.ndarray, tf: np.ndarray, m: np.ndarray, lo: int, hi: int) -> np.ndarray:
        """Scores of rows [lo, hi) of a table of ranks and counts."""
        start = at[lo : hi + 1]
        w = weight[rank[start[0] : start[-1]]]
        hit = np.flatnonzero(w)
        row = np.searchsorted(start, hit + start[0], side="right") - 1
        out = np.zeros(hi - lo, np.int64)
        np.add.at(out, row, part_score(w[hit], tf[start[0] + hit], m[lo:hi][row]))
        return out


def rank_documents(df: DataFrame, items: DataFrame, *, count: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per item its ``count`` best rows (fewer, if fewer score above 0): item_id, rank (from 1), doc_id, score.

    Terms are runs of ASCII letters and digits and of all other characters; only A-Z are lower-cased. A term's weight is
    floor(1000 ln((2 N + 2) / (2 df + 1))), a row's m 10 + 90 n N div L, its score the sum of w (10^9 tf div (1000 tf + 8 m)) over the item's
    different terms: N rows have a term, L is all their terms, n the row's, tf of them the item's term.

    A null text has no terms. Equal scores go by ascending id, rows of no id last; rows are ranked each, whatever their
    id. Items of no id or no terms give no rows; rows of one item id are one item. An empty table gives no rows; other columns are not
    looked at. Items of more than BLOCK bytes are searched in blocks, one pass over the rows for each.
    """
    spark = df.sparkSession
    kind, item_kind = df.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType
    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    asked = items.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("binary").alias("text")).dropna()
    blocks = max(1, -(-(asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK))
    most = TREE
    found = []
    for k in range(blocks):
        block = asked if blocks == 1 else asked.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k)
        queries = Queries([(r.item, bytes(r.text)) for r in block.toLocalIterator()])  # at most about BLOCK bytes
        shared = spark.sparkContext.broadcast(queries)

        def count_terms(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            number = shared.value.vocabulary.get
            for b in batches:
                n, which, tf = [], [], []
                for text in b.column(1):
                    words = terms(text.as_py())
                    times = Counter(map(number, words))
                    times.pop(None, None)
                    n.append(len(words))
                    which.append(list(times))
                    tf.append(list(times.values()))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(which, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.int32()))], names=["doc_id", "n", "terms", "tf"])

        vectors = materialise(rows.mapInArrow(count_terms, f"doc_id {kind}, n long, terms array<int>, tf array<int>").filter("n > 0"), "lexical")
        total = vectors.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()

        def frequencies(batches: Iterator[pa.RecordBatch], size=len(queries.vocabulary)) -> Iterator[pa.RecordBatch]:
            df_ = np.zeros(size, np.int64)
            for b in batches:
                df_ += np.bincount(b.column(0).flatten().to_numpy(), minlength=size)
            yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(df_), pa.int32()), pa.array(df_[df_ > 0])], names=["term", "df"])

        held = np.zeros(len(queries.vocabulary), np.int64)
        for r in vectors.select("terms").mapInArrow(frequencies, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():  # one row a term of the block
            held[r.term] = r.df
        weight = np.array([math.floor(1000 * math.log((2 * total.n + 2) / (2 * int(d) + 1))) for d in held], np.int64)
        by_frequency = np.argsort(-held, kind="stable")
        rank_of = np.empty(len(held), np.int64)
        rank_of[by_frequency] = np.arange(len(held))

        def search(batches: Iterator[pa.RecordBatch], shared=shared, rank_of=rank_of, weight=weight, rows_=total.n, length=total.l, id_type=_arrow_type(df, id_col)) -> Iterator[pa.RecordBatch]:
            q = shared.value
            best: list = [[] for _ in q.items]
            ids, ns, ranks, tfs, held = [], [], [], [], 0

            def grow() -> None:
                tree = Tree(ranks, tfs, np.array([10 + 90 * n * rows_ // length for n in ns], np.int64))
                asked = np.zeros(len(rank_of), np.int64)
                for i, t in enumerate(q.terms):
                    asked[rank_of[t]] = weight[t]
                    best[i] = tree.search(asked, best[i], count, ids)
                    asked[rank_of[t]] = 0

            for b in batches:
                columns = [b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3)]
                offsets = columns[2].offsets.to_numpy() - columns[2].offsets[0].as_py()
                r, t = rank_of[columns[2].flatten().to_numpy()], columns[3].flatten().to_numpy().astype(np.int64)
                for j in range(b.num_rows):
                    lo, hi = offsets[j], offsets[j + 1]
                    if lo == hi:
                        continue
                    ids.append(columns[0][j])
                    ns.append(columns[1][j])
                    ranks.append(r[lo:hi])
                    tfs.append(t[lo:hi])
                    held += hi - lo
                    if held >= most:
                        grow()
                        ids, ns, ranks, tfs, held = [], [], [], [], 0
            if ids:
                grow()
            where = [(i, *x) for i, rows in enumerate(best) for x in rows]
            columns = [pa.array([x[0] for x in where], pa.int32()), pa.array([x[3] for x in where], id_type), pa.array([-x[1] for x in where], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

        ranked = vectors.mapInArrow(search, f"item int, doc_id {kind}, score long")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)
        names = spark.createDataFrame([(i, x) for i, x in enumerate(queries.items)], f"item int, item_id {item_kind.simpleString()}")
        found.append(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    return out


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)
