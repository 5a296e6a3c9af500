"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, learned filters (WIDTH bytes wide, every STRIDE bytes) run over the whole document, and
their maxima are taken in chunks of two blocks of BLOCK bytes that overlap by one block. A hidden layer
describes each chunk; the largest and the mean description over all chunks give one probability.
The network is trained on a bounded sample of labelled documents; scoring is one pass, without shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, tidy

STRIDE, WIDTH, BLOCK = 4, 8, 256
EMBED, FILTERS, HIDDEN = 8, 48, 24
#: Bytes that go through the filters at a time.
STEP = 256 << 10


class Network:
    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        scale = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {"embed": scale(256, EMBED) * 16, "conv": scale(WIDTH * EMBED, FILTERS), "conv_b": np.zeros(FILTERS, np.float32), "chunk": scale(FILTERS, HIDDEN), "chunk_b": np.zeros(HIDDEN, np.float32), "out": scale(2 * HIDDEN, 1), "out_b": np.zeros(1, np.float32)}
        self.p["embed"][0] = 0  # padding

    @staticmethod
    def lay_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The texts' bytes, each after as much padding as windows reach over, so that none sees two texts, and padded to whole blocks; and each one's number of blocks."""
        lead = bytes(WIDTH - STRIDE)
        blocks = np.array([-(-(len(t) + len(lead)) // BLOCK) for t in texts], np.int64)
        joined = b"".join((lead + t).ljust(n * BLOCK, b"\0") for t, n in zip(texts, blocks.tolist(), strict=True))
        return np.frombuffer(joined + bytes(WIDTH), np.uint8), blocks

    def windows(self, data: np.ndarray) -> np.ndarray:
        """What each filter sees: rows of WIDTH embedded bytes, one every STRIDE bytes (the last byte's window included)."""
        e = self.p["embed"][data]
        n = (len(data) - WIDTH) // STRIDE
        return np.lib.stride_tricks.as_strided(e, (n, WIDTH * EMBED), (STRIDE * EMBED * 4, 4)).copy()

    def block_maxima(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each block: the largest response of each filter and its window; and the windows."""
        x = self.windows(data)
        r = (x @ self.p["conv"]).reshape(-1, BLOCK // STRIDE, FILTERS)
        at = r.argmax(axis=1)
        return np.take_along_axis(r, at[:, None], 1)[:, 0] + self.p["conv_b"], at + np.arange(len(r))[:, None] * (BLOCK // STRIDE), x

    def maxima(self, data: np.ndarray) -> np.ndarray:
        out = []
        for lo in range(0, len(data) - WIDTH, STEP):
            r = (self.windows(data[lo : lo + STEP + WIDTH]) @ self.p["conv"]).reshape(-1, BLOCK // STRIDE, FILTERS)
            out.append(r.max(axis=1))
        return np.concatenate(out) + self.p["conv_b"]

    def head(self, top: np.ndarray, blocks: np.ndarray) -> dict:
        """From block maxima to probabilities; chunk i of a text is its blocks i and i + 1 (the last: itself)."""
        starts = np.concatenate([[0], np.cumsum(blocks)[:-1]])
        last = np.zeros(len(top), bool)
        last[starts + blocks - 1] = True
        second = np.where(last, np.arange(len(top)), np.minimum(np.arange(len(top)) + 1, len(top) - 1))
        from_second = top[second] > top
        m = np.maximum(np.where(from_second, top[second], top), 0)
        h = np.tanh(m @ self.p["chunk"] + self.p["chunk_b"])
        high, mean = np.maximum.reduceat(h, starts, axis=0), np.add.reduceat(h, starts, axis=0) / blocks[:, None]
        f = np.concatenate([high, mean], axis=1)
        z = (f @ self.p["out"] + self.p["out_b"])[:, 0].astype(np.float64)
        return {"starts": starts, "second": second, "from_second": from_second, "m": m, "h": h, "high": high, "f": f, "p": 1 / (1 + np.exp(-np.clip(z, -30, 30)))}

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        data, blocks = self.lay_out(texts)
        return self.head(self.maxima(data), blocks)["p"]

    def gradients(self, texts: list[bytes], labels: np.ndarray) -> dict[str, np.ndarray]:
        data, blocks = self.lay_out(texts)
        top, at, x = self.block_maxima(data)
        s = self.head(top, blocks)
        owner = np.repeat(np.arange(len(texts)), blocks)
        dz = ((s["p"] - labels) / len(texts)).astype(np.float32)[:, None]
        g = {"out": s["f"].T @ dz, "out_b": dz.sum(0)}
        df = dz @ self.p["out"].T
        dh = (df[:, HIDDEN:] / blocks[:, None])[owner]
        is_high = s["h"] == s["high"][owner]
        is_high &= np.cumsum(is_high, axis=0) - np.repeat(np.cumsum(is_high, axis=0)[s["starts"]] - is_high[s["starts"]], blocks, axis=0) == 1  # the first of equals
        dh = (dh + df[:, :HIDDEN][owner] * is_high) * (1 - s["h"] ** 2)
        g |= {"chunk": s["m"].T @ dh, "chunk_b": dh.sum(0)}
        dm = (dh @ self.p["chunk"].T) * (s["m"] > 0)
        dtop = np.where(s["from_second"], 0, dm)
        np.add.at(dtop, s["second"], np.where(s["from_second"], dm, 0))
        g["conv_b"] = dtop.sum(0)
        d = dtop[:, :, None]
        g["conv"] = (x[at] * d).sum(0).T
        to_embed = (d * self.p["conv"].T).reshape(-1, EMBED)
        seen = data[at[:, :, None] * STRIDE + np.arange(WIDTH)].ravel()
        embed = np.stack([np.bincount(seen, to_embed[:, e], 256) for e in range(EMBED)], axis=1)
        embed[0] = 0
        return {k: v.astype(np.float32) for k, v in (g | {"embed": embed}).items()}

    def fit(self, texts: list[bytes], labels: np.ndarray, *, steps: int = 350, batch: int = 48, rate: float = 4e-3, seed: int = 0) -> Network:
        """``steps`` steps of Adam on the mean cross-entropy, however many texts there are; the order of batches is seeded."""
        rng = np.random.default_rng(seed)
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        order = np.zeros(0, np.int64)
        for t in range(1, steps + 1):
            if len(order) < min(batch, len(texts)):
                order = np.concatenate([order, rng.permutation(len(texts))])
            some, order = order[:batch], order[batch:]
            for k, g in self.gradients([texts[i] for i in some], labels[some]).items():
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                self.p[k] -= rate * (1 - t / (steps + 1)) * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        return self

    def place(self, texts: list[bytes], labels: np.ndarray, threshold: float) -> Network:
        """Shift the bias so that ``threshold`` tells ``texts`` apart best: most right of either label, in the middle of what does equally well."""
        p = self.score(texts)
        z = np.log(p) - np.log1p(-p)
        cuts = np.concatenate([[z.min() - 1], np.sort(z), [z.max() + 1]])
        cuts = (cuts[1:] + cuts[:-1]) / 2
        right = [(z[labels == 1] >= c).mean() + (z[labels == 0] < c).mean() for c in cuts]
        best = cuts[np.isclose(right, max(right))]
        self.p["out_b"] += np.float32(np.log(threshold / (1 - threshold)) - (best[0] + best[-1]) / 2)
        return self


def held_out(id_col: str) -> F.Column:
    """True for ids whose text's crc32 leaves 2 by 4; false for null ids."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, *, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", rows: int = 2400, longest: int = 20_000, threshold: float = 0.7, seed: int = 0) -> Network:
    """Fit on at most ``rows`` labelled documents, half of either label, of at most ``longest`` bytes.

    One in five of these is kept back from the fit; on them the score is placed so that ``threshold`` tells the labels apart
    best. Ids held out, null, of no label or of two labels are not learned from. Which rows are taken is settled by a digest of the
    id (of equal ids, of the text). With rows of one label only, or none, the network stays as seeded but for its bias.
    """
    agreed = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(F.min(label_col).alias("label"), F.max(label_col).alias("most")).filter("label = most")
    short = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).filter(F.octet_length("text") <= longest)
    digest = F.md5(F.col("id").cast("string").cast("binary"))
    learned, kept_back = [], []
    for label in (0, 1):
        # a label's first ids by digest; some of their documents may be too long, so more are drawn than used
        ids = agreed.filter(F.col("label") == label).select(F.col(id_col).alias("id")).orderBy(digest).limit(rows)
        found = short.join(F.broadcast(ids), "id").orderBy(digest, F.md5("text")).limit(rows // 2)
        for i, r in enumerate(found.select("text").collect()):
            (kept_back if i % 5 == 4 else learned).append((bytes(r.text), label))
    net = Network(seed)
    y = np.array([k for _, k in learned], np.float64)
    if 0 < y.sum() < len(y):
        net.fit([t for t, _ in learned], y, seed=seed)
        kept_back = kept_back if len({k for _, k in kept_back}) == 2 else learned
        net.place([t for t, _ in kept_back], np.array([k for _, k in kept_back]), threshold)
    elif len(y):
        net.p["out_b"][:] = 4 if y[0] else -4
    return net


def score(df: DataFrame, net: Network, *, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1), predicted (1 if score >= threshold), and ``carry``.

    The whole text is scored, from its bytes alone, however long; a null text counts as empty. Repeated rows and rows of no id are scored each (the
    latter are not held out). Columns that are not in ``carry`` are not looked at; no rows give no rows.
    """
    shared = df.sparkSession.sparkContext.broadcast(net)  # some 20,000 numbers
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = [shared.value.score(texts) for _, texts in chunks(b.column(2))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.concatenate(p) if p else np.zeros(0)), *b.columns[3:]], names=["doc_id", "held_out", "score", *b.schema.names[3:]])

    more = "".join(f", c{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(carry))
    return rows.mapInArrow(tidy(run), f"doc_id {kind}, held_out boolean, score double{more}").select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)])
