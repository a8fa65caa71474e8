"""Repeated passages by a depth-limited radix sort of suffixes, with hashes ahead of the byte passes.

Suffixes are grouped only through their first `depth` bytes, in passes; a group that a pass
leaves with one document is done. The suffixes at the start of the
windows are grouped by a sampled digit first: the 24-byte string of smallest hash inside the
window. Equal windows have the same digit at the same offset, so a digit that one document alone
holds ends all its windows at once, and about one row stands for fourteen suffixes.

1. Digit pass: digits are dealt to buckets; those found in two documents stay.
2. Window pass: the digits that stay take the bytes around them along; in each group the windows
   are grouped at every offset by a 64-bit hash of all `depth` bytes. A bucket is worked off in slices of digits.
3. Byte passes: windows that several documents have by their hash are sorted on by their bytes, eight at a time from the
   first. Equal groups are exactly the repeated windows, and every member but those of the smallest document is removed.
4. The removed windows of a document are united and cut out.

Rows travel as packed arrays per (task block, bucket), and what a block can decide alone it does
not send to the digit's bucket: of many documents with one digit or one surrounding only the
smallest goes there, the rest is dealt out evenly. So a passage that a third of all documents hold
costs its bucket one entry per block.

Texts are UTF-8 bytes; a null text is empty; texts shorter than `depth` lose nothing. Matches never
cross documents. Rows with equal ids do not remove each other; rows without id are left whole.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.arrow_text import blocks, bytes_of, merge_spans, mix, prefix_sums, runs, span_hashes

DEPTH = 50
DIGIT = 24
BUCKETS_PER_PARTITION = 1  # rows between buckets are at most the square of their number
_HASH_BITS = np.uint64(0xFFFFFFFFFFFFFFFF << 26 & 0xFFFFFFFFFFFFFFFF)
UNDECIDED, SHARED, DECIDED = 0, 1, 2
SLICE = 1 << 19  # windows that a bucket works off at a time


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays (with their types) as one compressed value."""
    parts = [np.array([len(arrays)], "<u4").tobytes()]
    for a in arrays:
        a = np.ascontiguousarray(a)
        parts += [a.dtype.str.encode().ljust(8), np.array([len(a)], "<u4").tobytes(), a.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    at, out = 4, []
    for _ in range(int(np.frombuffer(raw, "<u4", 1)[0])):
        kind = np.dtype(raw[at:at + 8].decode().strip())
        n = int(np.frombuffer(raw, "<u4", 1, at + 8)[0])
        out.append(np.frombuffer(raw, kind, n, at + 12))
        at += 12 + n * kind.itemsize
    return out


def _lowest(h: np.ndarray, width: int) -> np.ndarray:
    """Place of the smallest hash in every run of `width`, the leftmost on ties; h has at most ~_HASH_BITS + 1 entries."""
    low, size = (h & _HASH_BITS) | np.arange(len(h)).astype(np.uint64), 1
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < width:
        low = np.minimum(low[:len(low) - (width - size)], low[width - size:])
    return (low & ~_HASH_BITS).astype(np.int64)


def sampled(data: np.ndarray, offsets: np.ndarray, depth: int, digit: int):
    """(text, place, first, last, hash) of the sampled digits: text number, place of the digit, and the
    first and last window start that has it; places count from the start of `data`."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < depth:
        return none, none, none, none, np.zeros(0, np.uint64)
    at = np.arange(n - digit + 1)
    h = span_hashes(prefix_sums(data), at, at + digit)
    width = depth - digit + 1
    step = int(~_HASH_BITS) + 2 - width  # windows at a time, so that places fit beside the hash in texts of any length
    place = np.concatenate([c + _lowest(h[c:c + step + width - 1], width) for c in range(0, n - depth + 1, step)])  # of window start 0..n-depth
    starts = np.arange(n - depth + 1)
    text = np.searchsorted(offsets, starts, "right") - 1
    inside = starts + depth <= offsets[text + 1]
    starts, text, place = starts[inside], text[inside], place[inside]
    if not len(starts):
        return none, none, none, none, np.zeros(0, np.uint64)
    new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (text[1:] != text[:-1])]))
    last = np.concatenate([new[1:] - 1, [len(starts) - 1]])
    return text[new], place[new], starts[new], starts[last], h[place[new]]


def _several(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per entry: whether its key is held by several ids, and whether its id is the smallest of the key."""
    order = np.lexsort((ids, keys))
    k, d = keys[order], ids[order]
    edge = runs(k)
    low = np.repeat(d[edge[:-1]], np.diff(edge)) if len(k) else d
    high = np.repeat(d[edge[1:] - 1], np.diff(edge)) if len(k) else d
    many, least = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    many[order], least[order] = low != high, d == low
    return many, least


def _batch(columns: list, names: list[str], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _by_bucket(bucket: np.ndarray, arrays: list[np.ndarray]) -> tuple[list[int], list[bytes]]:
    order = np.argsort(bucket, kind="stable")
    edge = runs(bucket[order])
    numbers, data = [], []
    for a, b in zip(edge[:-1], edge[1:]):
        rows = order[a:b]
        numbers.append(int(bucket[rows[0]]))
        data.append(pack(*[x[rows] for x in arrays]))
    return numbers, data


def _spread(ids: np.ndarray, tags: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + tags.astype(np.uint64)) % np.uint64(buckets)).astype(np.int32)


def zipped(docs: DataFrame, key: str, text: str, buckets: int) -> DataFrame:
    """(home, id, tag, z): rows with their text compressed and the bucket of the row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for part in blocks(batches, text):
            data, offsets = bytes_of(part.column(1))
            raw = [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
            ids = part.column(0).to_numpy()
            tags = np.array([zlib.crc32(x) for x in raw], np.int64)
            yield _batch([_spread(ids, tags, buckets), ids, tags, [press.compress(x) for x in raw]], ["home", "id", "tag", "z"],
                         [pa.int32(), pa.int64(), pa.int64(), pa.binary()])

    return docs.select(F.col(key).cast("bigint").alias("id"), text).filter("id is not null").mapInArrow(
        run, "home int, id bigint, tag bigint, z binary")


def digit_rows(docs: DataFrame, key: str, text: str, buckets: int, depth: int, digit: int) -> DataFrame:
    """(bucket, data): the sampled digits of all documents, dealt to buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, text):
            data, offsets = bytes_of(part.column(1))
            t, place, _, _, h = sampled(data, offsets, depth, digit)
            if not len(t):
                continue
            tag = np.array([zlib.crc32(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:])], np.uint32)
            ids = part.column(0).to_numpy()
            many, least = _several(h, ids[t])
            state = np.where(many, np.where(least, SHARED, DECIDED), UNDECIDED).astype(np.uint8)
            bucket = np.where(state == DECIDED, _spread(ids[t], place, buckets),
                              (h >> np.uint64(40)) % np.uint64(buckets)).astype(np.int32)
            numbers, out = _by_bucket(bucket, [
                (h & np.uint64(0xFFFFFFFF)).astype(np.uint32), ((h >> np.uint64(32)) & np.uint64(0xFF)).astype(np.uint8),
                ids[t], tag[t], (place - offsets[t]).astype(np.uint32), state])
            yield _batch([numbers, out], ["bucket", "data"], [pa.int32(), pa.binary()])

    rows = docs.select(F.col(key).cast("bigint").alias("id"), text).filter("id is not null")
    return rows.mapInArrow(run, "bucket int, data binary")


def _joined(table: pa.Table) -> list[np.ndarray]:
    parts = [unpack(d.as_py()) for d in table.column("data")]
    return [np.concatenate(x) for x in zip(*parts)]


def shared_digits(rows: DataFrame, buckets: int) -> DataFrame:
    """(home, data): the digits held by several documents, packed per home bucket of their row."""
    def run(table: pa.Table) -> pa.Table:
        low, high, ids, tag, place, state = _joined(table)
        h = low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)
        stay = state != UNDECIDED
        own = np.flatnonzero(state != DECIDED)
        many, _ = _several(h[own], ids[own])
        # a block's SHARED entry stands for several documents
        held = np.isin(h[own], np.unique(h[own][state[own] == SHARED]))
        stay[own] |= many | held
        numbers, data = _by_bucket(_spread(ids[stay], tag[stay].astype(np.int64), buckets), [ids[stay], tag[stay], place[stay]])
        return pa.table({"home": pa.array(numbers, pa.int32()), "data": pa.array(data, pa.binary())})

    return rows.groupBy("bucket").applyInArrow(run, "home int, data binary")


def window_rows(texts: DataFrame, digits: DataFrame, buckets: int, depth: int, digit: int) -> DataFrame:
    """(bucket, data): the digits that stay with the bytes of their windows; decided ones as spans."""
    size_type = np.min_scalar_type(2 * depth)  # of the bytes around a digit

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        schema = {"bucket": pa.int32(), "data": pa.binary()}
        none = pa.table({c: pa.array([], t) for c, t in schema.items()})
        if not docs.num_rows or not found.num_rows:
            return none
        ids, tag, place = _joined(found)
        where = np.lexsort((tag, ids))
        ids, tag, place = ids[where], tag[where].astype(np.int64), place[where]
        numbers, data = [], []
        undo = zstandard.ZstdDecompressor()
        group: list[tuple] = []
        size = 0
        out_rows: list[list[np.ndarray]] = []

        def flush() -> None:
            raw = np.frombuffer(b"".join(g[2] for g in group), np.uint8)
            offsets = np.concatenate([[0], np.cumsum([len(g[2]) for g in group])]).astype(np.int64)
            t, at, first, last, h = sampled(raw, offsets, depth, digit)
            gi, gt = np.array([g[0] for g in group]), np.array([g[1] for g in group])
            wanted = np.concatenate([g[3].astype(np.int64) + o for g, o in zip(group, offsets)])
            ok = np.isin(at, wanted)
            t, at, first, last, h = t[ok], at[ok], first[ok], last[ok], h[ok]
            sums = prefix_sums(raw)
            whole = mix(span_hashes(sums, first, last + depth) + mix(h + (at - first).astype(np.uint64)))
            lengths = last + depth - first
            body = [raw[a:a + n].tobytes() for a, n in zip(first.tolist(), lengths.tolist())]
            out_rows.append([gi[t], gt[t], first - offsets[t], at - first, lengths, h, whole, np.array(body, object)])

        for i, g, z in zip(docs.column("id").to_pylist(), docs.column("tag").to_pylist(), docs.column("z")):
            a, b = np.searchsorted(ids, i, "left"), np.searchsorted(ids, i, "right")
            mine = place[a:b][tag[a:b] == g]
            if not len(mine):
                continue
            group.append((i, g, undo.decompress(z.as_py()), mine))
            size += len(group[-1][2])
            if size > 1 << 21:
                flush()
                group, size = [], 0
        if group:
            flush()
        if not out_rows:
            return none
        gi, gt, first, back, length, h, whole, body = [np.concatenate(x) for x in zip(*out_rows)]
        # equal surroundings inside this home: only the smallest document goes on, the others are decided
        many, least = _several(whole, gi)
        order = np.lexsort((~least, whole))
        edge = runs(whole[order])
        smallest = np.empty(len(whole), np.int64)
        smallest[order] = np.repeat(order[edge[:-1]], np.diff(edge))
        # unequal bytes under one hash are left to the next pass
        decided = many & ~least & (body == body[smallest]).astype(bool)
        own = ~decided
        bucket = ((h[own] >> np.uint64(40)) % np.uint64(buckets)).astype(np.int32)
        order = np.lexsort((h[own], bucket))
        edge = runs(bucket[order])
        index = np.flatnonzero(own)[order]
        for a, b in zip(edge[:-1], edge[1:]):
            r = index[a:b]
            numbers.append(int(bucket[order[a]]))
            data.append(pack(np.array([UNDECIDED], np.uint8), gi[r], gt[r], first[r].astype(np.uint32), back[r].astype(size_type),
                             length[r].astype(size_type), h[r], np.frombuffer(b"".join(body[r]), np.uint8)))
        if decided.any():
            r = np.flatnonzero(decided)
            home = _spread(gi[r[:1]], gt[r[:1]], buckets)
            numbers.append(int(home[0]))
            data.append(pack(np.array([DECIDED], np.uint8), gi[r], gt[r], first[r].astype(np.uint32), (first[r] + length[r]).astype(np.uint32)))
        return pa.table({"bucket": pa.array(numbers, pa.int32()), "data": pa.array(data, pa.binary())})

    return texts.groupBy("home").cogroup(digits.groupBy("home")).applyInArrow(run, "bucket int, data binary")


def equal_groups(raw: np.ndarray, at: np.ndarray, key: np.ndarray, depth: int) -> np.ndarray:
    """Group numbers of the windows at `at`: windows with one key are sorted on by their bytes, the most significant
    digit of up to eight bytes first, so equal numbers mean equal bytes. A pass sorts only groups its digit divides."""
    group = np.unique(key, return_inverse=True)[1].astype(np.int64)
    if not len(at):
        return group
    wide = 1 << min(3, depth.bit_length() - 1)  # bytes of a digit
    digits = np.ndarray(len(raw) - wide + 1, f"<u{wide}", np.ascontiguousarray(raw), strides=(1,))
    for p in range(0, depth, wide):
        w = digits[at + min(p, depth - wide)].astype(np.uint64)
        n = int(group.max()) + 1
        one = np.zeros(n, np.uint64)
        one[group] = w
        split = np.zeros(n, bool)
        split[group[w != one[group]]] = True
        rows = np.flatnonzero(split[group])
        if len(rows):
            order = rows[np.lexsort((w[rows], group[rows]))]
            new = np.concatenate([[True], (np.diff(group[order]) != 0) | (w[order][1:] != w[order][:-1])])
            group[order] = n + np.cumsum(new) - 1
    return group


def _slices(items: list[list[np.ndarray]], depth: int) -> Iterator[list[np.ndarray]]:
    """The entries of a bucket by ranges of their digit, about SLICE windows at a time; the items are sorted by digit,
    a digit is never divided."""
    if not items:
        return
    h = np.concatenate([x[5] for x in items])
    order = np.argsort(h)
    total = np.cumsum(np.concatenate([x[4] for x in items])[order].astype(np.int64) - depth + 1)
    bounds = np.unique(h[order][np.searchsorted(total, np.arange(SLICE, total[-1], SLICE))])
    del order, total
    cuts = [np.concatenate([[0], np.searchsorted(x[5], bounds, "left"), [len(x[5])]]) for x in items]
    places = [np.concatenate([[0], np.cumsum(x[4], dtype=np.int64)]) for x in items]
    for k in range(len(bounds) + 1):
        part = [[c[cut[k]:cut[k + 1]] for c in x[:6]] + [x[6][place[cut[k]]:place[cut[k + 1]]]]
                for x, cut, place in zip(items, cuts, places) if cut[k] < cut[k + 1]]
        if part:
            yield [np.concatenate(c) for c in zip(*part)]


def repeated_spans(rows: DataFrame, buckets: int, depth: int) -> DataFrame:
    """(home, data): spans of windows that also start in a smaller document, per home of the row."""
    def run(table: pa.Table) -> pa.Table:
        ids, tags, starts, ends = [], [], [], []
        undecided = []
        for d in table.column("data"):
            state, *arrays = unpack(d.as_py())
            if state[0] == DECIDED:
                for out, a in zip((ids, tags, starts, ends), arrays):
                    out.append(a.astype(np.int64))
            else:
                undecided.append(arrays)
        for gi, gt, first, back, length, h, raw in _slices(undecided, depth):
            length = length.astype(np.int64)
            offset = np.concatenate([[0], np.cumsum(length)])
            sums = prefix_sums(raw)
            n = length - depth + 1  # windows of each entry
            entry = np.repeat(np.arange(len(n)), n)
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = offset[entry] + step
            key = mix(span_hashes(sums, at, at + depth) + mix(h[entry] + (back[entry].astype(np.int64) - step + 64).astype(np.uint64)))
            again = np.flatnonzero(_several(key, gi[entry])[0])
            same = equal_groups(raw, at[again], key[again], depth)
            many, least = _several(same, gi[entry[again]])
            gone = again[many & ~least]
            if len(gone):
                new = np.concatenate([[True], (np.diff(gone) != 1) | (np.diff(entry[gone]) != 0)])
                a = gone[new]
                b = gone[np.concatenate([new[1:], [True]])]
                e = entry[a]
                ids.append(gi[e].astype(np.int64))
                tags.append(gt[e].astype(np.int64))
                starts.append(first[e].astype(np.int64) + step[a])
                ends.append(first[e].astype(np.int64) + step[b] + depth)
        if not ids:
            return pa.table({"home": pa.array([], pa.int32()), "data": pa.array([], pa.binary())})
        i, g, s, e = [np.concatenate(x) for x in (ids, tags, starts, ends)]
        numbers, data = _by_bucket(_spread(i, g, buckets), [i, g.astype(np.uint32), s.astype(np.uint32), e.astype(np.uint32)])
        return pa.table({"home": pa.array(numbers, pa.int32()), "data": pa.array(data, pa.binary())})

    return rows.groupBy("bucket").applyInArrow(run, "home int, data binary")


def _cut(key: str, kept_text: bool):
    names = [key, "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * kept_text

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        ids = tag = start = end = np.zeros(0, np.int64)
        if found.num_rows:
            ids, tag, start, end = [x.astype(np.int64) for x in _joined(found)]
            order = np.argsort(ids, kind="stable")
            ids, tag, start, end = ids[order], tag[order], start[order], end[order]
        undo = zstandard.ZstdDecompressor()
        out: list[list] = [[] for _ in names]
        for i, g, z in zip(docs.column("id").to_pylist(), docs.column("tag").to_pylist(), docs.column("z")):
            raw = undo.decompress(z.as_py())
            a, b = np.searchsorted(ids, i, "left"), np.searchsorted(ids, i, "right")
            mine = tag[a:b] == g
            s, e = merge_spans(start[a:b][mine], end[a:b][mine])
            edges = [0, *np.stack([s, e], 1).ravel().tolist(), len(raw)]
            kept = b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2]))
            row = [i, len(raw), len(raw) - len(kept), len(s), hashlib.sha256(kept).hexdigest(), kept]
            for column, value in zip(out, row):
                column.append(value)
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, out, types)})

    kinds = "bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * kept_text
    return run, f"`{key}` {kinds}"


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", depth: int = DEPTH, digit: int | None = None,
                   buckets: int | None = None, kept_text: bool = True) -> DataFrame:
    """Per row: key, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 and the kept bytes.

    `buckets` grows with the session's shuffle partitions, so a bucket stays as large as a partition.
    """
    spark = docs.sparkSession
    buckets = buckets or BUCKETS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    digit = digit or max(1, depth * DIGIT // DEPTH)
    texts = zipped(docs, key, text, buckets)
    digits = shared_digits(digit_rows(docs, key, text, buckets, depth, digit), buckets)
    spans = repeated_spans(window_rows(texts, digits, buckets, depth, digit), buckets, depth)
    run, schema = _cut(key, kept_text)
    done = texts.groupBy("home").cogroup(spans.groupBy("home")).applyInArrow(run, schema)
    raw = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    whole = docs.filter(F.col(key).isNull()).select(
        F.col(key).cast("bigint").alias(key), F.octet_length(raw).cast("bigint").alias("n_bytes"),
        F.lit(0).cast("bigint").alias("n_removed"), F.lit(0).cast("bigint").alias("n_spans"),
        F.sha2(raw, 256).alias("kept_sha256"), *[raw.alias("kept")] * kept_text)
    return done.unionByName(whole)
