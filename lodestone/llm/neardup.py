"""Near-duplicate groups from bottom-k sketches of one hash function.

Each document's set of word shingles is hashed once; its SKETCH least values are its sketch. Documents
of one set are one node. Inverted lists of the INDEXED least values generate the pairs of nodes to
look at:

* in a list of up to CROWD nodes, all pairs;
* in a longer one, each node with PIVOTS fixed nodes of the list and its smallest one, so no group emits all its pairs (in PIVOT_LISTS of a node's lists).

The sketch of the union of two sets estimates their similarity and drops most pairs; the rest are
confirmed on the full shingle sets, and links become components. What longer lists may still hide, a
link between two components that shares crowded values only, is looked for exactly once more: of each
crowded value whose nodes are still in several components, all nodes outside the largest of them meet all
nodes in blocks of bounded bytes, where matrix products count the intersections of their full sets, and a block pair
emits no more links than join its components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WordHashes, chunks, materialise, tidy, windows
from .components import components

SKETCH, INDEXED, CROWD, PIVOTS = 32, 24, 50, 3
#: A node meets the pivots of so many of its crowded lists. What they don't link is looked for in all its lists afterwards, so none is lost by it.
PIVOT_LISTS = 8
#: Of a block of nodes: bytes of full sets (but for a single larger set), and nodes.
BLOCK_BYTES, BLOCK = 2 << 20, 512
#: Blocks of a value that meet in one tile, on either side.
TILE = 64
#: Cells of a matrix that counts intersections.
COLUMNS = 2 << 20
#: Sketches must agree in this share of the union's: six standard deviations under 0.75. Linked nodes fall below with a chance of 3e-8.
LIKELY = 0.29
#: A node's indexed values that are crowded, as a share, from which a link could rest on crowded values alone. Linked nodes share
#: each of their union's INDEXED least values with a chance of 0.75 or more: fewer than this all told with one of 3e-9.
MOSTLY_CROWDED = 0.2


def shingles(text: bytes, k: int, hashes: WordHashes | None = None) -> np.ndarray:
    """The sorted 63-bit hashes of the distinct runs of ``k`` words; of fewer words, of the whole sequence."""
    words = text.lower().split()  # bytes: only A-Z change, and only 0x20 and 0x09-0x0D part words
    if not words:
        return np.zeros(0, np.uint64)
    h = (WordHashes() if hashes is None else hashes).of(words)
    return np.unique(windows(h, min(k, len(words))) >> np.uint64(1))


def sketch(df: DataFrame, *, k: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, digest of the set, sketch (its least values, ascending)."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()  # of this task alone
        for b in batches:
            for at, texts in chunks(b.column(1)):
                sets = [shingles(t, k, hashes) for t in texts]
                least = pa.array([s[:SKETCH].view(np.int64) for s in sets], pa.list_(pa.int64()))
                digests = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), pa.array([len(s) for s in sets], pa.int64()), digests, least], names=["doc_id", "n_shingles", "digest", "sketch"])

    rows = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(tidy(run), f"doc_id {kind}, n_shingles long, digest binary, sketch array<long>")


def _near(n_a: str = "n_a", n_b: str = "n_b", percent: int = 75) -> F.Column:
    """Sets of these sizes can be similar enough."""
    return 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)


def confirm(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union; ``texts``: (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        held: dict[int, tuple[bytes, np.ndarray]] = {}
        size = 0

        def of(node: int, text: bytes) -> np.ndarray:
            nonlocal size
            if node not in held or held[node][0] != text:
                if size > BLOCK_BYTES:
                    held.clear()
                    size = 0
                held[node] = text, shingles(text, k, hashes)
                size += len(text) + held[node][1].nbytes
            return held[node][1]

        for b in batches:
            keep = []
            for i in range(b.num_rows):
                x, y = (of(b.column(j)[i].as_py(), b.column(j + 2)[i].as_py()) for j in (0, 1))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    full = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("t_b")), "b").join(texts.select(F.col("node").alias("a"), F.col("text").alias("t_a")), "a")
    return full.select("a", "b", "t_a", "t_b").mapInArrow(tidy(run), f"a {kind}, b {kind}")


def near_duplicates(df: DataFrame, *, k: int = 5, percent: int = 75, likely: float = LIKELY, mostly: float = MOSTLY_CROWDED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (least id reachable by links, itself included), kept (doc_id = component_id).

    Two documents are linked if 100 * intersection >= percent * union of their shingle sets. A null, empty or blank text has
    an empty set and no links. Rows of equal id are one document, linked by any of their texts. Rows with a null id have no links,
    a null component and are kept. Other columns are not looked at.

    A pair at the threshold itself is missed with a chance of 3.3e-8 at most: that its union sketch agrees in less than ``likely``, or that a node of it has fewer than a share ``mostly`` of
    crowded values though the pair shares crowded ones only. ``likely=0`` and ``mostly=0`` drop both tests: every pair that shares a retained value is then verified on its full sets.
    """
    rows = materialise(sketch(df, k=k, id_col=id_col, text_col=text_col), "sketches")
    nodes = rows.filter("n_shingles > 0 and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    nodes = materialise(nodes, "nodes")

    # an id's texts keep their own values, sizes and sketches: ``set`` tells them apart
    entries = nodes.select("node", F.xxhash64("digest").alias("set"), "n", F.explode(F.slice("sketch", 1, INDEXED)).alias("value"))
    shared = entries.groupBy("value").agg(F.count("*").alias("times")).filter("times > 1")
    entries = materialise(entries.join(shared, "value"), "entries")
    small, crowded = entries.filter(F.col("times") <= CROWD), entries.filter(F.col("times") > CROWD)

    side = lambda e, x: e.select("value", F.col("node").alias(x), F.col("n").alias(f"n_{x}"))
    close = side(small, "a").join(side(small, "b"), "value").filter((F.col("a") < F.col("b")) & _near(percent=percent)).select("a", "b")
    # in crowded lists only nodes that crowded values describe in part: others share a value of a short list with whom they are linked
    own = Window.partitionBy("node", "set")  # INDEXED rows at most
    crowded = crowded.withColumns({"here": F.count("*").over(own), "nth": F.row_number().over(own.orderBy("value"))})
    crowded = materialise(crowded.filter(F.col("here") >= mostly * F.least(F.col("n"), F.lit(INDEXED))).select("node", "set", "n", "value", "nth"), "crowded")
    first = crowded.filter(F.col("nth") <= PIVOT_LISTS)
    # written first, so that Spark can split the rows of a value when they meet its pivots; a node meets each pivot once, in however many lists
    pivot = lambda i: F.min_by(F.struct(F.col("node").alias("b"), F.col("n").alias("n_b")), F.struct(F.xxhash64("node", F.lit(i)) if i else "n", "node"))
    pivots = materialise(first.groupBy("value").agg(F.array(*[pivot(i) for i in range(PIVOTS + 1)]).alias("pivots")), "pivots")
    star = first.join(pivots, "value").groupBy("node", "set", "n").agg(F.array_distinct(F.flatten(F.collect_set("pivots"))).alias("p"))
    star = star.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.explode("p").alias("p")).select("a", "n_a", "p.*")
    star = star.filter((F.col("a") != F.col("b")) & _near(percent=percent)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = close.union(star).distinct()

    sketches = nodes.select("node", "sketch")  # of an id of several texts one for each: any two that agree will do
    pairs = pairs.join(sketches.select(F.col("node").alias("a"), F.col("sketch").alias("s_a")), "a").join(sketches.select(F.col("node").alias("b"), F.col("sketch").alias("s_b")), "b")
    union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, SKETCH)
    pairs = pairs.withColumn("u", union).filter(F.size(F.array_intersect(F.array_intersect("u", "s_a"), "s_b")) >= likely * F.size("u"))
    # pairs of ids of several texts may repeat; not made distinct here, so that Spark can split the rows of a pivot
    pairs = materialise(pairs.select("a", "b"), "pairs")

    needed = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(crowded.select("node")).distinct()
    texts = df.select(F.col(id_col).alias("node"), F.col(text_col).cast("binary").alias("text")).filter("text is not null")
    # a merge join at every size: Spark would broadcast a small list of nodes, and the plan would change as the corpus grows
    texts = materialise(texts.join(needed.hint("merge"), "node").distinct(), "texts")
    links = materialise(confirm(pairs, texts, k, percent), "confirmed")
    roots = components(links)

    more = _across(crowded, roots, texts, k, percent)
    # ids whose rows have different sets join the nodes of these
    several = rows.filter("doc_id is not null").groupBy("doc_id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).filter("x <> y").select("doc_id")
    own = rows.join(several, "doc_id").join(nodes.select("digest", "node"), "digest").select(F.col("node").alias("a"), F.col("doc_id").alias("b")).distinct()
    roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more).union(own.filter("a <> b")))

    of_set = nodes.select("digest", "node").join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("component_id"))
    # rows of one set have the component of its node; those of an id with several sets, an empty one too, that of the id
    by_id = several.join(roots.withColumnRenamed("node", "doc_id"), "doc_id").withColumnRenamed("root", "of_id")
    # empty rows and rows of no id, of which there may be very many, meet in no join by what they all have in common
    named = rows.filter("doc_id is not null")
    found = named.filter("n_shingles > 0").join(of_set, "digest", "left").select("doc_id", "n_shingles", "component_id")
    found = found.unionByName(named.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    found = found.join(by_id, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("of_id", "component_id", "doc_id").alias("component_id"))
    nameless = rows.filter("doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(nameless).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _across(crowded: DataFrame, roots: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (a, b) between nodes of different components that share crowded values."""
    kind = crowded.schema["node"].dataType.simpleString()
    known = materialise(crowded.join(roots, "node", "left").select("value", "node", "n", F.coalesce("root", "node").alias("root")), "known")
    of_root = known.groupBy("value", "root").agg(F.count("*").alias("here"), F.sum("n").alias("members"))
    of_value = of_root.groupBy("value").agg(F.count("*").alias("roots"), F.sum("here").alias("all"), F.sum("members").alias("all_members"), F.max(F.struct("here", "root", "members")).alias("top")).filter("roots > 1")
    size = lambda rows, members: F.ceil(F.greatest(rows / BLOCK, 8 * members / BLOCK_BYTES, F.lit(1))).cast("int")
    open_ = of_value.select("value", F.col("top.root").alias("most"), size(F.col("top.here"), F.col("top.members")).alias("tops"), size(F.col("all") - F.col("top.here"), F.col("all_members") - F.col("top.members")).alias("fews"))
    top = F.col("root") == F.col("most")
    known = known.join(open_, "value").select("value", "node", "root", "tops", "fews", top.alias("top"), F.pmod(F.xxhash64("node"), F.when(top, F.col("tops")).otherwise(F.col("fews"))).alias("block"))
    known = materialise(known, "known")
    sets = materialise(_sets(texts.join(known.select("node").distinct(), "node"), k), "sets")
    blocks = known.join(sets, "node").groupBy("value", "top", "block", "tops", "fews").agg(F.collect_list(F.struct("node", "root", "members")).alias("m"))
    blocks = materialise(blocks, "blocks")
    # the nodes of a value's largest component don't meet each other; the blocks of a value meet in tiles of so many by so many, so that no task holds all pairs of one
    tiles = lambda c: F.ceil(F.col(c) / TILE).cast("int")
    up_to = lambda n: F.sequence(F.lit(0), n - 1)
    own = F.pmod("block", F.when(F.col("top"), tiles("tops")).otherwise(tiles("fews")))
    partners = F.concat(F.transform(up_to(tiles("fews")), lambda i: F.struct(F.lit(False).alias("top"), i.alias("column"))), F.transform(up_to(tiles("tops")), lambda i: F.struct(F.lit(True).alias("top"), i.alias("column"))))
    left = blocks.filter("not top").select("value", own.alias("row"), F.explode(partners).alias("p"), "block", "m").select("value", "row", F.col("p.top").alias("other_top"), F.col("p.column").alias("column"), "block", "m")
    right = blocks.select("value", F.explode(up_to(tiles("fews"))).alias("row"), F.col("top").alias("other_top"), own.alias("column"), F.col("block").alias("other"), F.col("m").alias("o"))
    pairs = left.join(right, ["value", "row", "other_top", "column"]).filter("other_top or other >= block").select("m", "o")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                sides = []
                for j in (0, 1):
                    rows = b.column(j)[i].values
                    parts = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.field("members")]
                    sides.append((rows.field("node").to_numpy(), rows.field("root").to_numpy(), np.array([len(x) for x in parts]), np.concatenate(parts)))
                _, _, a, c = joined(*sides, percent)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, c)), pa.array(np.maximum(a, c))], names=["a", "b"])

    return pairs.mapInArrow(tidy(run), f"a {kind}, b {kind}").distinct()


def _sets(texts: DataFrame, k: int) -> DataFrame:
    """(node, members): the full set of each text, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            for at, some in chunks(b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(some)), pa.array([shingles(t, k, hashes).tobytes() for t in some], pa.binary())], names=["node", "members"])

    return texts.select("node", "text").mapInArrow(tidy(run), f"node {texts.schema['node'].dataType.simpleString()}, members binary")


def joined(left: tuple, right: tuple, percent: int) -> tuple[np.ndarray, ...]:
    """Of all pairs of two blocks (nodes, roots, set sizes, members one after the other): such links that join all components that links join."""
    (ids, root, n, flat), (ids2, root2, n2, flat2) = left, right
    both = np.intersect1d(flat, flat2)  # all else is in no intersection
    shared = np.zeros((len(n), len(n2)), np.int64)
    step = max(1, COLUMNS // max(len(n), len(n2)))
    for lo in range(0, len(both), step):
        part, has = both[lo : lo + step], []
        for size, members in ((n, flat), (n2, flat2)):
            at = np.minimum(np.searchsorted(part, members), len(part) - 1)
            on = part[at] == members
            m = np.zeros((len(size), len(part)), np.float32)
            m[np.repeat(np.arange(len(size)), size)[on], at[on]] = 1
            has.append(m)
        shared += np.rint(has[0] @ has[1].T).astype(np.int64)  # exact: counts under 2 to the 24th
    linked = (root[:, None] != root2) & (100 * shared >= percent * (n[:, None] + n2 - shared))
    x, y = np.nonzero(linked)
    parent: dict[int, int] = {}

    def find(r: int) -> int:
        while parent.setdefault(r, r) != r:
            r = parent[r]
        return r

    keep = []
    for i, (r, q) in enumerate(zip(root[x].tolist(), root2[y].tolist(), strict=True)):
        r, q = find(r), find(q)
        if r != q:
            parent[max(r, q)] = min(r, q)
            keep.append(i)
    return x[keep], y[keep], ids[x[keep]], ids2[y[keep]]
