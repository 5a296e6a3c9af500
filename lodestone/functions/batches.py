"""Arrow batches of sorted rows as tables of whole groups, many groups to a table."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Rows of a table at least, so that the cost of a step in Python is shared by many groups.
ROWS = 1 << 16


def changes(table: pa.Table, *keys: str) -> np.ndarray:
    """Whether a row's keys differ from those of the row before; nulls are equal to each other."""
    out = np.zeros(table.num_rows, bool)
    out[:1] = True
    for k in keys:
        column = table.column(k).combine_chunks()
        codes = (column.chunk(0) if isinstance(column, pa.ChunkedArray) and column.num_chunks else column).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        out[1:] |= codes[1:] != codes[:-1]
    return out


def whole_groups(batches: Iterable[pa.RecordBatch], *keys: str, rows: int = ROWS) -> Iterator[pa.Table]:
    """The batches' rows, sorted by ``keys``, as tables that no group straddles; a table has ``rows`` rows or one group more."""
    kept: list[pa.RecordBatch] = []
    have, least = 0, rows
    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        have += batch.num_rows
        if have < least:
            continue
        table = pa.Table.from_batches(kept).combine_chunks()
        cut = int(np.flatnonzero(changes(table, *keys))[-1])
        if cut:
            yield table.slice(0, cut)
            table = table.slice(cut)
        kept, have = table.to_batches(), table.num_rows
        least = max(rows, 2 * have)  # a group of many batches is not looked through at each of them
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks()
