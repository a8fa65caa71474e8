"""Texts of Arrow batches as byte arrays, their words, and rolling hashes; all in numpy.

Tasks see their rows in blocks of bounded bytes, whatever the size of an Arrow batch, so
memory does not depend on how long the texts of a table are (one text is never cut).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20
_PRIME = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_PRIME, -1, 1 << 64)
_tables: dict[str, np.ndarray] = {}

# Letters A-Z lower-cased; a word is made of digits, a-z and every byte from 128 on.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD = np.zeros(256, dtype=bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(
            column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(at, np.int64 if large else np.int32)[
        column.offset:column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(batches: Iterable[pa.RecordBatch], text: str, limit: int = BLOCK_BYTES,
           rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most `limit` bytes of text, or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = bytes_of(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            end = min(max(end, at + 1), at + rows, batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def ids_of(column: pa.Array) -> np.ndarray:
    """An id column without nulls as int64; rows without id have to be handled before."""
    return column.cast(pa.int64()).to_numpy(zero_copy_only=False)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (each value keeps a distinct image)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _tables.get("power")
    if have is None or len(have) < n:
        size = max(n, 1 << 21)
        for name, base in (("power", _PRIME), ("inverse", _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            with np.errstate(over="ignore"):
                _tables[name] = np.multiply.accumulate(table)
    return _tables["power"], _tables["inverse"]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which span_hashes reads the hash of any span in constant time."""
    power, _ = _powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end]; equal bytes give equal hashes."""
    _, inverse = _powers(len(sums))
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Words:
    """Words of many texts: byte spans, hashes, and per text the range of its words."""

    def __init__(self, column: pa.Array):
        raw, offsets = bytes_of(column)
        self.data = LOWER[raw]
        inside = np.zeros(len(raw) + 1, bool)
        inside[:-1] = WORD[self.data]
        before = np.zeros(len(raw) + 1, bool)
        before[1:] = inside[:-1]
        edges = offsets[offsets < len(raw) + 1]
        before[edges] = False
        self.starts = np.flatnonzero(inside & ~before)
        after = np.zeros(len(raw) + 1, bool)
        after[:-1] = inside[1:]
        after[edges[edges > 0] - 1] = False
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.hashes = span_hashes(prefix_sums(self.data), self.starts, self.ends)
        self.bounds = np.searchsorted(self.starts, offsets)  # words of text i: bounds[i]:bounds[i+1]

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()

    def text_of(self, words: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, words, "right") - 1


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Start of each run of equal values, and the length at the end."""
    n = len(sorted_values)
    if not n:
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1, [n]])


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans as disjoint, maximal spans in order."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate([[True], s[1:] > e[:-1]])
    last = np.concatenate([first[1:], [True]])
    return s[first], e[last]


def text_rows(df, text: str, *keep: str):
    """The named columns only, so that other columns never reach Python or a shuffle."""
    return df.select(*keep, text)
