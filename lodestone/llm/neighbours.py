"""Nearest neighbours by inner product: NN-descent builds a graph, queries walk it greedily.

Equal vectors are one node, and a node is known by a code of one byte a component while the graph is built and
walked; only what a query ends with is scored on the original vectors. The graph starts from groups of nodes that
fall on the same sides of random planes. Each round of NN-descent gathers every node's neighbours, and some of the nodes it is a
neighbour of, by joins; scores all their pairs; and proposes each to the other, until few lists change. Queries keep a
beam of the best nodes seen and send themselves to the best that aren't expanded yet, where the
neighbours' codes lie ready; the walk ends when the beam of each query is expanded whole.

Lists travel as binary columns, so a row holds one node's whole list, and the work between two
shuffles is numpy on sorted rows. No step gathers more than a list of bounded length under one key.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialise, mix, remove, shared_dir, tidy

#: Neighbours of a node, and as many at most that it is a neighbour of; tables of random planes; nodes of a group on average.
DEGREE, TABLES, GROUP = 20, 4, 2048
#: Proposals a node takes from one list; share of list entries that are new below which building stops.
TAKEN, STILL = 6, 0.3
#: Nodes of a query's beam for each doubling of the table; more than asked for that are scored exactly.
BEAM_A_BIT, SPARE = 24, 12


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector): rows with an id and a vector of finite numbers, not all zero."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).filter("id is not null and vector is not null")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return rows.filter(finite & F.exists("vector", lambda x: x != 0))


def _flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a binary column, one row after the other, and how many each row has."""
    if not len(column):
        return np.zeros(0, kind), np.zeros(0, np.int64)
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return data.copy().view(kind), np.diff(at) // np.dtype(kind).itemsize


def _binary(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    at = np.concatenate([[0], np.cumsum(counts)]) * flat.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(np.ascontiguousarray(flat).tobytes())])


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    """List columns as rows; components that a vector lacks are 0."""
    size = np.diff(column.offsets.to_numpy())
    m = np.zeros((len(size), int(size.max(initial=1))), kind)
    m[np.repeat(np.arange(len(size)), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = column.flatten().to_numpy(zero_copy_only=False)
    return m


def _whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by their first column, cut where that changes."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        key = b.column(0).to_numpy()
        if held and held[0].column(0)[0].as_py() != key[-1]:
            cut = int(np.searchsorted(key, key[-1]))
            yield pa.Table.from_batches([*held, b.slice(0, cut)]).combine_chunks()
            held, b = [], b.slice(cut)
        elif not held and key[0] != key[-1]:
            cut = int(np.searchsorted(key, key[-1]))
            yield pa.Table.from_batches([b.slice(0, cut)])
            b = b.slice(cut)
        held.append(b)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _columns(t: pa.Table) -> list[pa.Array]:
    return [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in t.columns]


def _by_key(df: DataFrame, *more: str) -> DataFrame:
    return df.repartition(df.columns[0]).sortWithinPartitions(df.columns[0], *more)


def _best(owner: np.ndarray, u: np.ndarray, score: np.ndarray, known: np.ndarray, most: int) -> np.ndarray:
    """Places of each owner's ``most`` best, owners ascending, best first, ties to the smaller id; of one id a known one before a new one like it."""
    order = np.lexsort((-score, 1 - known, u, owner))
    o, x = owner[order], u[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (o[1:] != o[:-1]) | (x[1:] != x[:-1])
    order = order[fresh]
    order = order[np.lexsort((u[order], -score[order], owner[order]))]
    o = owner[order]
    return order[np.arange(len(o)) - np.searchsorted(o, o) < most]


LIST = "v long, us binary, scores binary, known binary"


def _lists(owner: np.ndarray, u: np.ndarray, score: np.ndarray, known: np.ndarray, most: int) -> pa.RecordBatch:
    """Rows of LIST, one for each owner."""
    keep = _best(owner, u, score, known, most)
    names, counts = np.unique(owner[keep], return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(names), _binary(u[keep], counts), _binary(score[keep], counts), _binary(known[keep], counts)], names=["v", "us", "scores", "known"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for t in _whole_keys(batches):
        v, us, scores, known = _columns(t)
        (u, n), (s, _), (k, _) = _flat(us, "i8"), _flat(scores, "f8"), _flat(known, "i1")
        yield _lists(np.repeat(v.to_numpy(), n), u, s, k, DEGREE)


def encode(rows: DataFrame, dim: int) -> DataFrame:
    """(v, code, scale) of (v, vector): a byte a component, and what it is to be multiplied by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _matrix(b.column(1), np.float64)
            scale = np.abs(m).max(axis=1, initial=0) / 127
            code = np.zeros((len(m), dim), np.int8)
            code[:, : m.shape[1]] = np.rint(m / np.where(scale > 0, scale, 1)[:, None])
            yield pa.RecordBatch.from_arrays([b.column(0), _binary(code.ravel(), np.full(len(m), dim)), pa.array(scale)], names=["v", "code", "scale"])

    return rows.mapInArrow(tidy(run), "v long, code binary, scale double")


def _groups(nodes: DataFrame, dim: int, rows: int, seed: int) -> DataFrame:
    """First lists: the best in groups by random planes. A crowded side of the planes is dealt out in parts."""
    bits = max(0, int(np.ceil(np.log2(max(1, rows / GROUP)))))
    tables = TABLES if bits else 1
    planes = np.random.default_rng(seed).standard_normal((tables, bits, dim)).astype(np.float32)

    def side(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _flat(b.column(1), "i1")[0].reshape(-1, dim).astype(np.float32)
            for t in range(tables):
                at = ((m @ planes[t].T > 0) << np.arange(bits)).sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(m), t, np.int32)), pa.array(at.astype(np.int64)), *b.columns], names=["t", "at", "v", "code", "scale"])

    sides = nodes.mapInArrow(tidy(side), "t int, at long, v long, code binary, scale double")
    here = sides.groupBy("t", "at").agg(F.count("*").alias("here"))
    part = F.pmod(F.xxhash64("v", "t"), F.ceil(F.col("here") / GROUP))
    # dealt out anew after the join, so that a crowded side is split before and after
    parts = sides.join(here, ["t", "at"]).withColumn("part", part).drop("here").repartition("t", "at", "part")

    def score(group: pa.Table) -> pa.Table:
        v, code, scale = (group.column(c).combine_chunks() for c in ("v", "code", "scale"))
        v, code, scale = (c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in (v, code, scale))
        v, scale = v.to_numpy(), scale.to_numpy()
        m = _flat(code, "i1")[0].reshape(-1, dim).astype(np.float32)
        n = min(DEGREE, len(v) - 1)
        out = []
        for lo in range(0, len(v) if n else 0, 1024):
            s = (m[lo : lo + 1024] @ m.T).astype(np.float64) * scale[lo : lo + 1024, None] * scale
            s[np.arange(len(s)), lo + np.arange(len(s))] = -np.inf
            at = np.argpartition(-s, n - 1, axis=1)[:, :n]
            owner = np.repeat(v[lo : lo + len(s)], n)
            out.append(_lists(owner, v[at].ravel(), np.take_along_axis(s, at, 1).ravel(), np.zeros(at.size, np.int8), n))
        schema = pa.schema([("v", pa.int64()), ("us", pa.binary()), ("scores", pa.binary()), ("known", pa.binary())])
        return pa.Table.from_batches(out, schema)

    found = parts.groupBy("t", "at", "part").applyInArrow(score, LIST)
    return _by_key(found).mapInArrow(tidy(_merge), LIST)


def around(graph: DataFrame, nodes: DataFrame) -> DataFrame:
    """(v, us, codes, scales, worsts): of each node its list, and of the nodes that have it in theirs up to DEGREE, drawn by a digest
    of the edge; of all these the code, its scale and the lowest score of their own lists."""

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v, (u, n) = b.column(0).to_numpy(), _flat(b.column(1), "i8")
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _binary(np.zeros(len(u), np.uint64), n)], names=["v", "us", "draws"])
            owner, other = u, np.repeat(v, n)
            draw = mix(owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix(other.astype(np.uint64))) | np.uint64(1)
            order = np.lexsort((draw, owner))
            order = order[np.arange(len(order)) - np.searchsorted(owner[order], owner[order]) < DEGREE]  # of one batch: a hub's edges aren't all sent
            names, counts = np.unique(owner[order], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(names), _binary(other[order], counts), _binary(draw[order], counts)], names=["v", "us", "draws"])

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_keys(batches):
            v, us, draws = _columns(t)
            (u, n), (draw, _) = _flat(us, "i8"), _flat(draws, "u8")
            owner = np.repeat(v.to_numpy(), n)
            order = np.lexsort((draw, u, owner))
            order = order[np.concatenate([[True], (owner[order][1:] != owner[order][:-1]) | (u[order][1:] != u[order][:-1])])] if len(order) else order
            order = order[np.lexsort((draw[order], owner[order]))]
            back = draw[order] > 0
            o = owner[order]
            number = np.cumsum(back) - back
            keep = ~back | (number - number[np.searchsorted(o, o)] < DEGREE)
            yield pa.RecordBatch.from_arrays([pa.array(o[keep]), pa.array(u[order][keep])], names=["v", "u"])

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s, n = _flat(b.column(2), "f8")
            last = np.where(n == DEGREE, s[np.maximum(np.cumsum(n) - 1, 0)] if len(s) else 0, -np.inf)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(last)], names=["u", "worst"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_keys(batches):
            v, u, code, scale, worst = _columns(t)
            names, counts = np.unique(v.to_numpy(), return_counts=True)
            data, size = _flat(code, "i1")
            codes = _binary(data, np.add.reduceat(size, np.cumsum(counts) - counts))
            yield pa.RecordBatch.from_arrays([pa.array(names), _binary(u.to_numpy(), counts), codes, _binary(scale.to_numpy(), counts), _binary(worst.to_numpy(), counts)], names=["v", "us", "codes", "scales", "worsts"])

    pairs = _by_key(graph.select("v", "us").mapInArrow(tidy(both), "v long, us binary, draws binary")).mapInArrow(tidy(edges), "v long, u long")
    known = nodes.withColumnRenamed("v", "u").join(graph.select("v", "us", "scores").mapInArrow(tidy(least), "u long, worst double"), "u", "left")
    met = pairs.join(known.fillna(float("-inf"), ["worst"]), "u").select("v", "u", "code", "scale", "worst")
    return _by_key(met).mapInArrow(tidy(gather), "v long, us binary, codes binary, scales binary, worsts binary")


def _descend(graph: DataFrame, met: DataFrame, dim: int) -> DataFrame:
    """One round: all that stand in one node's surroundings are proposed to each other."""

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                some = b.slice(lo, 256)
                (u, size), (codes, _), (scale, _), (worst, _) = (_flat(some.column(i), k) for i, k in ((1, "i8"), (2, "i1"), (3, "f8"), (4, "f8")))
                row, col = np.repeat(np.arange(len(size)), size), np.arange(len(u)) - np.repeat(np.cumsum(size) - size, size)
                m = np.zeros((len(size), int(size.max(initial=1)), dim), np.float32)
                m[row, col] = codes.reshape(-1, dim)
                there, floor, by, index = np.zeros(m.shape[:2], bool), np.full(m.shape[:2], np.inf), np.zeros(m.shape[:2]), np.zeros(m.shape[:2], np.int64)
                there[row, col], floor[row, col], by[row, col], index[row, col] = True, worst, scale, np.arange(len(u))
                s = np.matmul(m, m.transpose(0, 2, 1)).astype(np.float64) * by[:, :, None] * by[:, None, :]
                s = np.where(there[:, None, :] & (s > floor[:, :, None]), s, -np.inf)
                s[:, np.arange(s.shape[1]), np.arange(s.shape[1])] = -np.inf
                n = min(TAKEN, s.shape[2])
                at = np.argpartition(-s, n - 1, axis=2)[:, :, :n]
                best = np.take_along_axis(s, at, 2)
                g, i, k = np.nonzero(np.isfinite(best))
                if len(g):
                    yield _lists(u[index[g, i]], u[index[g, at[g, i, k]]], best[g, i, k], np.zeros(len(g), np.int8), DEGREE)

    def old(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = _flat(b.column(1), "i8")[1]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], _binary(np.ones(n.sum(), np.int8), n)], names=b.schema.names)

    return _by_key(graph.mapInArrow(tidy(old), LIST).union(met.mapInArrow(tidy(propose), LIST))).mapInArrow(tidy(_merge), LIST)


def build(nodes: DataFrame, dim: int, rows: int, *, seed: int = 11) -> tuple[DataFrame, DataFrame]:
    """The graph over ``nodes`` (v, code, scale), and what `around` says of it."""
    graph = materialise(_groups(nodes, dim, rows, seed), "graph")
    met = materialise(around(graph, nodes), "around")
    while rows > GROUP:  # a single group's lists are complete
        better = materialise(_descend(graph, met, dim), "graph")
        new = better.select(F.sum(F.length(F.replace("known", F.lit(b"\x01"), F.lit(b"")))), F.sum(F.length("known"))).first()
        discard(graph)
        discard(met)
        graph, met = better, materialise(around(better, nodes), "around")
        if (new[0] or 0) < STILL * (new[1] or 0):
            break
    return graph, met


#: A node that more than one in so many questions of a step ask is a hub.
HUBS = 200

BEAM = "q long, code binary, scale double, us binary, scores binary, done binary, open int"


def _next(done: np.ndarray, counts: np.ndarray, most: int) -> np.ndarray:
    """Whether each beam entry (best first in each row) is among the first ``most`` that aren't expanded."""
    waits = done == 0
    row = np.repeat(np.arange(len(counts)), counts)
    number = np.cumsum(waits) - waits
    first = np.concatenate([[0], np.cumsum(waits)])[np.cumsum(counts) - counts]
    return waits & (number - first[row] < most)


def search(met: DataFrame, queries: DataFrame, dim: int, beam: int) -> DataFrame:
    """The beams of ``queries`` (q, code, scale; each a node) after a greedy walk from the node itself: BEAM, best first."""
    spark = met.sparkSession
    name = f"lodestone_around_{uuid.uuid4().hex[:12]}"
    # kept in buckets, a file each, so that the walk's steps do not shuffle it again
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    folder = f"{shared_dir(spark)}/{name}"
    met.select("v", "us", "codes", "scales").repartition(buckets, "v").write.bucketBy(buckets, "v").sortBy("v").option("path", folder).saveAsTable(name)
    try:
        return _walk(spark.table(name), queries, dim, beam)
    finally:
        spark.sql(f"DROP TABLE {name}")
        remove(spark, folder)


def _walk(ready: DataFrame, queries: DataFrame, dim: int, beam: int) -> DataFrame:
    """`search` over the table of neighbours and their codes."""
    expand = beam // 2

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q, n = b.column(0).to_numpy(), np.ones(b.num_rows, np.int64)
            m = _flat(b.column(1), "i1")[0].reshape(-1, dim) * b.column(2).to_numpy()[:, None]
            own = np.einsum("ij,ij->i", m, m)
            yield pa.RecordBatch.from_arrays([*b.columns, _binary(q, n), _binary(own, n), _binary(np.zeros(len(q), np.int8), n), pa.array(n.astype(np.int32))], names=["q", "code", "scale", "us", "scores", "done", "open"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                some = b.slice(lo, 512)
                (u, n), (s, _), (done, _) = (_flat(some.column(i), k) for i, k in ((3, "i8"), (4, "f8"), (5, "i1")))
                go = np.flatnonzero(_next(done, n, expand))
                row = np.repeat(np.arange(len(n)), n)[go]
                worst = np.where(n == beam, s[np.cumsum(n) - 1], -np.inf)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([pa.array(u[go]), *(some.column(i).take(take) for i in range(3)), pa.array(worst[row])], names=["v", "q", "code", "scale", "worst"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                some = b.slice(lo, 512)
                q, own, worst = (some.column(i).to_numpy() for i in (0, 2, 3))
                code = _flat(some.column(1), "i1")[0].reshape(-1, dim).astype(np.float32)
                (u, n), (codes, _), (scales, _) = (_flat(some.column(i), k) for i, k in ((4, "i8"), (5, "i1"), (6, "f8")))
                row = np.repeat(np.arange(len(n)), n)
                s = np.einsum("ij,ij->i", codes.reshape(-1, dim).astype(np.float32), code[row]).astype(np.float64) * scales * own[row]
                keep = s > worst[row]
                counts = np.bincount(row[keep], minlength=len(n))
                there = counts > 0
                empty = pa.nulls(int(there.sum()), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(q[there]), empty, pa.nulls(len(empty), pa.float64()), _binary(u[keep], counts[there]), _binary(s[keep], counts[there]), empty, pa.nulls(len(empty), pa.int32())], names=["q", "code", "scale", "us", "scores", "done", "open"])

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_keys(batches):  # of each query its beam, and as many answers as it has asked at most
            q, code, scale, us, scores, done, _ = _columns(t)
            is_beam = np.asarray(code.is_valid())
            (u, n), (s, _) = _flat(us, "i8"), _flat(scores, "f8")
            mine = is_beam[np.repeat(np.arange(len(n)), n)]
            known = np.zeros(len(u), np.int8)
            before = _flat(done.filter(pa.array(is_beam)), "i1")[0]
            known[mine] = before | _next(before, n[is_beam], expand)
            owner = np.repeat(q.to_numpy(), n)
            keep = _best(owner, u, s, known, beam)
            names, counts = np.unique(owner[keep], return_counts=True)
            open_ = np.bincount(np.repeat(np.arange(len(names)), counts), known[keep] == 0).astype(np.int32)
            rows = pa.array(np.flatnonzero(is_beam))
            yield pa.RecordBatch.from_arrays([pa.array(names), code.take(rows), scale.take(rows), _binary(u[keep], counts), _binary(s[keep], counts), _binary(known[keep], counts), pa.array(open_)], names=["q", "code", "scale", "us", "scores", "done", "open"])

    now = materialise(queries.mapInArrow(tidy(start), BEAM), "beam")
    ended = now.limit(0)
    while not now.isEmpty():
        asked = now.mapInArrow(tidy(ask), "v long, q long, code binary, scale double, worst double")
        # a node that many queries ask at once would be one task's work: the few such nodes are handed to all tasks instead
        total = now.agg(F.sum(F.least("open", F.lit(expand)))).first()[0]
        hubs = [r.v for r in asked.groupBy("v").agg(F.count("*").alias("n")).filter(F.col("n") * HUBS > total).collect()]  # fewer than HUBS
        met = asked.filter(~F.col("v").isin(hubs)).join(ready, "v")
        if hubs:
            # dealt anew, so that asking and answering are not two Python workers of one task
            met = met.unionByName(asked.filter(F.col("v").isin(hubs)).repartition("q").join(F.broadcast(ready.filter(F.col("v").isin(hubs))), "v"))
        answers = met.select("q", "code", "scale", "worst", "us", "codes", "scales").mapInArrow(tidy(answer), BEAM)
        after = materialise(_by_key(now.union(answers)).mapInArrow(tidy(take), BEAM), "beam")
        discard(now)
        now, over = after.filter("open > 0"), after.filter("open = 0")
        if not over.isEmpty():
            ended = ended.union(over)
            now = materialise(now, "beam")
        else:
            now = after
    return ended


def _exact(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """(q, u, score) of (q, u): inner products of the original vectors in double precision."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (_matrix(b.column(i), np.float64) for i in (2, 3))
            n = min(x.shape[1], y.shape[1])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.einsum("ij,ij->i", x[:, :n], y[:, :n]))], names=["q", "u", "score"])

    full = pairs.join(vectors.select(F.col("v").alias("u"), F.col("vector").alias("y")), "u").join(vectors.select(F.col("v").alias("q"), F.col("vector").alias("x")), "q")
    return full.select("q", "u", "x", "y").mapInArrow(tidy(run), "q long, u long, score double")


def nearest(df: DataFrame, *, count: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per query (id divisible by ``every``) its ``count`` nearest found: query_id, rank (from 1), vec_id, score (double).

    All rows are indexed and are candidates, but a query's own; ties go to the smaller id. Null ids and vectors that are null, zero,
    or hold a null or non-finite component take no part; components that a vector lacks beside longer ones count as 0; rows of equal
    id count once (with the least vector). Equal vectors cost one node, however many there are. The beam grows with the
    logarithm of the table. Recall is tested against brute force. No rows give no rows.
    """
    rows = usable(df, id_col, vector_col).groupBy("id").agg(F.min("vector").alias("vector"))
    rows = materialise(rows.withColumns({"x": F.xxhash64("vector"), "y": F.xxhash64(F.lit(1), "vector")}), "vectors")
    of = rows.groupBy("x", "y").agg(F.min("id").alias("v"))
    rows = materialise(rows.join(of, ["x", "y"]).select("v", "id", "vector"), "vectors")
    vectors = rows.filter("id = v").select("v", "vector")
    total = vectors.agg(F.count("*").alias("rows"), F.max(F.size("vector")).alias("dim")).first()
    dim = total.dim or 1
    nodes = materialise(encode(vectors, dim), "nodes")
    graph, met = build(nodes, dim, total.rows)
    asked = rows.filter(F.pmod("id", F.lit(every)) == 0).select("v", "id")
    queries = nodes.join(asked.select("v").distinct(), "v").select(F.col("v").alias("q"), "code", "scale")
    beam = search(met, queries, dim, max(count + 1 + SPARE, BEAM_A_BIT * int(max(1, total.rows)).bit_length()))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            u, n = _flat(b.column(1), "i8")
            keep = np.arange(len(u)) - np.repeat(np.cumsum(n) - n, n) < count + 1 + SPARE
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column(0).to_numpy(), n)[keep]), pa.array(u[keep])], names=["q", "u"])

    beam = _exact(beam.select("q", "us").mapInArrow(tidy(first), "q long, u long"), vectors)
    # the least ids of each vector: more cannot be among a query's nearest; found in parts, so that no vector's rows meet in one task
    part = rows.select("v", "id", F.pmod(F.xxhash64("id"), F.lit(64)).alias("part"))
    for by in (("v", "part"), ("v",)):
        part = part.withColumn("k", F.row_number().over(Window.partitionBy(*by).orderBy("id"))).filter(F.col("k") <= count + 1)
    top = beam.withColumn("k", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "u"))).filter(F.col("k") <= count + 1)
    found = top.select("q", F.col("u").alias("v"), "score").join(part.select("v", F.col("id").alias("vec_id")), "v")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= count + 1)
    found = found.join(asked.select(F.col("v").alias("q"), F.col("id").alias("query_id")), "q").filter("query_id <> vec_id")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= count).select("query_id", "rank", "vec_id", "score")
