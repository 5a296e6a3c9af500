"""URL rules held as a sorted array of 64-bit digests that executors map into memory.

The index is one file: sorted xxhash64 keys, offsets and the rules' full strings. Spark ships it to
every executor (`SparkContext.addFile`, also to ones that start later). Tasks build every string that
could be a fitting rule (each suffix of the host at a label edge, joined with each rule-length prefix
of the path), probe the keys by one vectorised binary search a batch, and compare stored strings to
rule out collisions.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: An index of more bytes than this is refused: each executor keeps a copy on its disk.
MAX_BYTES = 2 << 30


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#`` or the end. Both empty without ``://``."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    raw, path = (F.coalesce(F.regexp_extract(url, parts, i), F.lit("")) for i in (1, 2))
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def build_index(rules: Iterable[tuple[str, str]], folder: str) -> str:
    """Write the index of (rule string ``host/path-prefix``, verdict) pairs; a later pair replaces an earlier equal one."""
    last = dict(rules)
    digests = np.array([xxhash.xxh64_intdigest(r) for r in last], np.uint64)
    order = np.argsort(digests, kind="stable")
    names, verdicts = list(last), list(last.values())
    blob = [names[i].encode() for i in order]
    ends = np.cumsum([0, *map(len, blob)]).astype(np.int64)
    kinds = sorted(set(verdicts))
    if digests.nbytes + ends.nbytes + int(ends[-1]) > MAX_BYTES:
        raise ValueError(f"the rules take more than {MAX_BYTES} bytes")
    lengths = sorted({len(r) - r.index("/") for r in names})
    path = os.path.join(folder, f"url-rules-{uuid.uuid4().hex}.bin")
    with open(path, "wb") as f:
        head = repr({"n": len(names), "kinds": kinds, "lengths": lengths}).encode()
        f.write(len(head).to_bytes(8, "little") + head)
        f.write(digests[order].tobytes() + ends.tobytes() + bytes(kinds.index(verdicts[i]) for i in order) + b"".join(blob))
    return path


class Index:
    def __init__(self, path: str):
        import ast

        raw = np.memmap(path, np.uint8, "r") if os.path.getsize(path) else np.zeros(0, np.uint8)
        size = int.from_bytes(raw[:8].tobytes(), "little")
        head = ast.literal_eval(raw[8 : 8 + size].tobytes().decode())
        n, at = head["n"], 8 + size
        self.kinds, self.lengths = head["kinds"], head["lengths"]
        self.keys = np.frombuffer(raw[at : at + 8 * n], np.uint64)
        at += 8 * n
        self.ends = np.frombuffer(raw[at : at + 8 * (n + 1)], np.int64)
        at += 8 * (n + 1)
        self.verdict, self.text = raw[at : at + n], raw[at + n :]

    def probe(self, strings: list[str]) -> np.ndarray:
        """The index of the rule equal to each string, or -1."""
        digests = np.array([xxhash.xxh64_intdigest(s) for s in strings], np.uint64)
        found = np.full(len(strings), -1)
        if not len(self.keys) or not strings:
            return found
        at = np.searchsorted(self.keys, digests)
        for i in np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == digests):
            k = at[i]
            while k < len(self.keys) and self.keys[k] == digests[i]:
                if self.text[self.ends[k] : self.ends[k + 1]].tobytes() == strings[i].encode():
                    found[i] = k
                    break
                k += 1
        return found

    def rule(self, k: int) -> str:
        return self.text[self.ends[k] : self.ends[k + 1]].tobytes().decode()


@lru_cache(maxsize=4)
def _opened(name: str) -> Index:
    return Index(SparkFiles.get(name))


def candidates(host: str, path: str, lengths: list[int]) -> Iterator[str]:
    """Strings of rules that could fit, longest host first, then longest path."""
    prefixes = [path[:n] for n in reversed(lengths) if n <= len(path)]
    at = 0
    while prefixes:
        for p in prefixes:
            yield host[at:] + p
        at = host.find(".", at) + 1
        if not at:
            return


def judge_urls(df: DataFrame, rules: Iterable[tuple[str, str]], *, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """Per row: page_id, host, path, rule (the longest fitting one, else null), verdict (the rule's, else ``default``).

    ``rules``: (``host/path-prefix``, verdict). A rule fits its host and all subdomains where the url's
    path starts with the rule's path; the one with most characters wins, on ties the longer host. A null url, or
    one without ``://``, has empty host and path and gets the default. Repeated rows are judged each;
    other columns are not looked at. No shuffle.
    """
    spark: SparkSession = df.sparkSession
    file = build_index(rules, tempfile.mkdtemp(prefix="lodestone-rules-"))
    spark.sparkContext.addFile(file)
    name = os.path.basename(file)

    @F.pandas_udf("rule string, verdict string")
    def verdict(hosts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        index = _opened(name)
        strings, owner = [], []
        for i, (h, p) in enumerate(zip(hosts, paths, strict=True)):
            new = list(candidates(h, p, index.lengths))
            strings += new
            owner += [i] * len(new)
        best: list[int] = [-1] * len(hosts)
        found = index.probe(strings)
        for j in np.flatnonzero(found >= 0):  # in the order of candidates(): a later one must be longer to win
            i = owner[j]
            if best[i] < 0 or len(strings[j]) > len(index.rule(best[i])):
                best[i] = found[j]
        return pd.DataFrame({"rule": [index.rule(k) if k >= 0 else None for k in best], "verdict": [index.kinds[index.verdict[k]] if k >= 0 else default for k in best]})

    rows = df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("__url"))
    host, path = host_and_path(F.col("__url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    return rows.withColumn("r", verdict("host", "path")).select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.col("r.verdict").alias("verdict"))
