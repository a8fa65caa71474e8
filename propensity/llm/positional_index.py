"""Benchmark decontamination with a distributed positional inverted index.

Words are lower-cased runs of letters, digits and non-ASCII characters. A window is `width`
consecutive words of a benchmark item (an item with fewer words is one window); equal windows are
one, with all their items. The steps:

1. postings: documents are dealt to segments of bounded size where they lie; a segment stores, for each
   benchmark word, the sorted places where its documents have it, next to the documents themselves.
   The segments are written once, and nothing is shuffled;
2. term statistics: list lengths summed over all segments. A window with a word that no document has
   cannot occur and is dropped;
3. intersection: in each segment the lists of a window's rarest words, moved by their offsets, are
   intersected, rarest first;
4. phrases: what is left is compared word by word with the document, byte for byte.

Proximity matches are documents where the rarest words of a window vote for starts at most
`slop` apart, that is, occur near each other though not as the phrase.

The benchmark is the stated query set: it is taken in blocks of bounded words, one block after the other
against all documents. Driver and tasks hold one block; a task holds one segment (about SEGMENT_BYTES of text, or
one longer document) and at most about CANDIDATES starts at a time.

A null text has no words; documents without words give zero counts; items without words match nothing.
Equal items each count; an item without id is matched like others but has no name to report. Every row of `docs`
gives one row, judged by its own text, whether its id is null or repeated. Other columns, whatever their
names, travel inside the segment.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.arrow_text import Words, blocks, merge_spans, runs
from propensity.session import new_path

WIDTH = 10
ANCHORS = 3  # words of a window whose postings are intersected
BLOCK_WORDS = 1_000_000  # benchmark words of a block: bounds the driver and the closures
SEGMENT_BYTES = 1 << 19
CANDIDATES = 1 << 20
SLOP = 5
ROW_GROUP = 16 << 20  # of the written segments, so that a reader holds few of them

_FOUND = pa.list_(pa.struct([("doc", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("items", pa.list_(pa.string()))]))
_FOUND_SQL = "array<struct<doc:int,start:int,end:int,items:array<string>>>"
_INDEX_SQL = f"docs binary, found {_FOUND_SQL}, n_words array<int>, terms array<int>, sizes array<int>, places array<int>"

Batches = Iterator[pa.RecordBatch]


@dataclass
class Windows:
    """The different windows of a block of benchmark items."""

    words: Words  # of all items
    first: np.ndarray  # first word of each window
    size: np.ndarray
    owners: list[list[str]]  # ids of the items with the window
    vocabulary: np.ndarray  # sorted word hashes
    terms: np.ndarray  # the vocabulary number of each word

    def __len__(self) -> int:
        return len(self.first)

    def anchors(self, frequency: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(windows, terms, offsets) of the windows whose words all occur: the rarest different words of each,
        rarest first; -1 where a window has fewer."""
        windows, terms, offsets = [], [], []
        for w, (a, n) in enumerate(zip(self.first.tolist(), self.size.tolist())):
            here, at = np.unique(self.terms[a:a + n], return_index=True)
            often = frequency[here]
            if not often.all():
                continue
            order = np.lexsort((at, often))[:count]
            fill = [-1] * (count - len(order))
            windows.append(w)
            terms.append([*here[order].tolist(), *fill])
            offsets.append([*at[order].tolist(), *fill])
        shape = (len(windows), count)
        return np.array(windows, np.int64), np.array(terms, np.int64).reshape(shape), np.array(offsets, np.int64).reshape(shape)


def windows_of(rows: list[tuple], width: int = WIDTH) -> Windows:
    """Windows of (item_id, text) rows."""
    words = Words(pa.array([t for _, t in rows], pa.string()))
    numbers: dict[bytes, int] = {}
    exact = np.array([numbers.setdefault(words.word(k), len(numbers)) for k in range(len(words.hashes))], np.int32)
    seen: dict[bytes, int] = {}
    first, size, owners = [], [], []
    for i, (name, _) in enumerate(rows):
        a, b = int(words.bounds[i]), int(words.bounds[i + 1])
        for s in range(a, max(a + 1, b - width + 1) if b > a else a):
            e = min(s + width, b)
            w = seen.setdefault(exact[s:e].tobytes(), len(first))
            if w == len(first):
                first.append(s)
                size.append(e - s)
                owners.append([])
            if name is not None and str(name) not in owners[w][-1:]:
                owners[w].append(str(name))
    vocabulary = np.unique(words.hashes)
    return Windows(words, np.array(first, np.int64), np.array(size, np.int64), owners, vocabulary,
                   np.searchsorted(vocabulary, words.hashes))


def item_blocks(items: DataFrame, key: str, text: str, block_words: int) -> Iterator[list[tuple]]:
    """Rows of the benchmark, in blocks of about `block_words` words, one block at a time."""
    items = items.select(F.col(key).cast("string").alias("id"), F.col(text).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(size // (3 * block_words)) + 1
    for b in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == b)
        rows = [tuple(r) for r in part.collect()]
        if rows:
            yield rows


def _known(hashes: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number in the vocabulary, position) of the words that are in it."""
    if not len(vocabulary):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sieve = np.zeros(1 << 20, bool)
    sieve[vocabulary & np.uint64((1 << 20) - 1)] = True
    at = np.flatnonzero(sieve[hashes & np.uint64((1 << 20) - 1)])
    number = np.minimum(np.searchsorted(vocabulary, hashes[at]), len(vocabulary) - 1)
    same = vocabulary[number] == hashes[at]
    return number[same], at[same]


# ---- segments

def _packed(text: str) -> Callable[[Batches], Batches]:
    """Documents to segments: a slice of rows, all columns, as one value."""
    def run(batches: Batches) -> Batches:
        for part in blocks(batches, text, limit=SEGMENT_BYTES):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(part)
            yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary()), pa.array([[]], _FOUND)],
                                             ["docs", "found"])

    return run


def _documents(data: pa.Scalar) -> pa.RecordBatch:
    return pa.ipc.open_stream(data.as_buffer()).read_next_batch()


def _indexed(vocabulary: np.ndarray, text: str, gap: int) -> Callable[[Batches], Batches]:
    """Adds the postings of a block's vocabulary to segments. Places count through the documents of the
    segment, with `gap` places between two documents, so that no window reaches from one into the next."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for i in range(batch.num_rows):
                docs = _documents(batch.column(0)[i])
                words = Words(docs.column(docs.schema.get_field_index(text)))
                number, at = _known(words.hashes, vocabulary)
                order = np.argsort(number, kind="stable")
                number, at = number[order], at[order]
                edge = runs(number)
                terms, sizes = (number[edge[:-1]], np.diff(edge)) if len(number) else (number, number)
                places = at + gap * words.text_of(at)
                lists = [np.diff(words.bounds), terms, sizes, places]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), batch.column(1).slice(i, 1).cast(_FOUND)]
                    + [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x.astype(np.int32))) for x in lists],
                    ["docs", "found", "n_words", "terms", "sizes", "places"])

    return run


def term_counts(index: DataFrame, size: int) -> np.ndarray:
    """Occurrences in all documents of each term: the lengths of its lists, `size` terms at most."""
    rows = (index.select(F.explode(F.arrays_zip("terms", "sizes")).alias("x"))
            .groupBy("x.terms").agg(F.sum("x.sizes").alias("n")).collect())
    out = np.zeros(size, np.int64)
    for term, n in rows:
        out[term] = n
    return out


class Postings:
    """The lists of one segment, by term."""

    def __init__(self, n_words: np.ndarray, terms: np.ndarray, sizes: np.ndarray, places: np.ndarray, size: int, gap: int):
        edge = np.concatenate([[0], np.cumsum(sizes)])
        self.low, self.count = np.zeros(size + 1, np.int64), np.zeros(size + 1, np.int64)  # the last one for "no term"
        self.low[terms], self.count[terms] = edge[:-1], sizes
        self.places = places.astype(np.int64)
        self.keys = np.repeat(terms.astype(np.int64), sizes) << 32 | self.places
        self.n_words = n_words.astype(np.int64)
        self.base = np.cumsum(self.n_words) - self.n_words + gap * np.arange(len(n_words))

    def starts(self, terms: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the entry, start) for every place of each entry's term."""
        n = self.count[terms]
        entry = np.repeat(np.arange(len(terms)), n)
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return entry, self.places[self.low[terms][entry] + step] - offsets[entry]

    def between(self, terms: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether the list of each term has a place from `low` to `high`."""
        if not len(self.keys):
            return np.zeros(len(terms), bool)
        key = terms << 32 | np.maximum(low, 0)
        at = np.searchsorted(self.keys, key)
        found = self.keys[np.minimum(at, len(self.keys) - 1)]
        return (at < len(self.keys)) & (found <= (terms << 32 | np.maximum(high, 0))) & (high >= 0)

    def document(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, word) at each place; the word may lie outside the document."""
        doc = np.maximum(np.searchsorted(self.base, places, "right") - 1, 0)
        return doc, places - self.base[doc]

    def _slices(self, terms: np.ndarray) -> Iterator[np.ndarray]:
        """Numbers of windows with postings of all their anchors, about CANDIDATES starts at a time."""
        live = np.flatnonzero(((terms < 0) | (self.count[terms] > 0)).all(axis=1))
        part = np.cumsum(self.count[terms[live, 0]]) // CANDIDATES
        edge = runs(part)
        for a, b in zip(edge[:-1], edge[1:]):
            yield live[a:b]

    def phrases(self, terms: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, start) where the lists of all anchors meet."""
        for live in self._slices(terms):
            entry, start = self.starts(terms[live, 0], offsets[live, 0])
            win = live[entry]
            for a in range(1, terms.shape[1]):
                t, at = terms[win, a], start + offsets[win, a]
                ok = (t < 0) | self.between(np.maximum(t, 0), at, at)
                win, start = win[ok], start[ok]
            yield win, start

    def near(self, terms: np.ndarray, offsets: np.ndarray, slop: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, place) where all anchors vote for starts from that of one of them to `slop` further."""
        for live in self._slices(terms):
            for a in range(terms.shape[1]):
                mine = live[terms[live, a] >= 0]
                entry, start = self.starts(terms[mine, a], offsets[mine, a])
                place, win = start + offsets[mine, a][entry], mine[entry]
                for b in range(terms.shape[1]):
                    t, at = terms[win, b], start + offsets[win, b]
                    ok = (t < 0) | self.between(np.maximum(t, 0), at, at + slop)
                    win, start, place = win[ok], start[ok], place[ok]
                yield win, place


def _segments(batches: Batches, size: int, gap: int) -> Iterator[tuple[pa.RecordBatch, int, Postings]]:
    for batch in batches:
        for i in range(batch.num_rows):
            lists = [batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in range(2, 6)]
            yield batch, i, Postings(*lists, size, gap)


def _exact(block: Windows, words: Words, text: np.ndarray, start: np.ndarray, win: np.ndarray) -> np.ndarray:
    """Whether window `win` stands at word `start` of the text: hashes first, then all bytes."""
    at, first, size = words.bounds[text] + start, block.first[win], block.size[win]
    ok = np.ones(len(win), bool)
    for j in range(int(size.max(initial=0))):
        here = np.flatnonzero(ok & (size > j))
        ok[here] = words.hashes[at[here] + j] == block.words.hashes[first[here] + j]
    for k in np.flatnonzero(ok).tolist():
        a, f = int(at[k]), int(first[k])
        ok[k] = all(words.word(a + j) == block.words.word(f + j) for j in range(int(size[k])))
    return ok


def _matched(block: Windows, anchors: tuple, text: str, gap: int) -> Callable[[Batches], Batches]:
    """Adds the windows found to segments; gives (docs, found, n_words)."""
    windows, terms, offsets = anchors

    def found_in(batch: pa.RecordBatch, i: int, index: Postings) -> list[dict]:
        docs, out = None, []
        for entry, place in index.phrases(terms, offsets):
            win = windows[entry]
            doc, start = index.document(place)
            inside = (start >= 0) & (start + block.size[win] <= index.n_words[doc])
            win, doc, start = win[inside], doc[inside], start[inside]
            if not len(win):
                continue
            if docs is None:
                docs = _documents(batch.column(0)[i])
            chosen, number = np.unique(doc, return_inverse=True)
            words = Words(docs.column(docs.schema.get_field_index(text)).take(pa.array(chosen)))
            ok = _exact(block, words, number, start, win)
            out += [{"doc": d, "start": s, "end": s + n, "items": block.owners[w]} for d, s, n, w in zip(
                doc[ok].tolist(), start[ok].tolist(), block.size[win[ok]].tolist(), win[ok].tolist())]
        return out

    def run(batches: Batches) -> Batches:
        for batch, i, index in _segments(batches, len(block.vocabulary), gap):
            found = batch.column(1)[i].as_py() + found_in(batch, i, index)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([found], _FOUND), batch.column(2).slice(i, 1)],
                                             ["docs", "found", "n_words"])

    return run


def _written(df: DataFrame) -> DataFrame:
    path = new_path(df.sparkSession, "postings")
    df.write.option("parquet.block.size", str(ROW_GROUP)).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def postings(rows: DataFrame, vocabulary: np.ndarray, text: str = "text", gap: int = WIDTH, packed: bool = False) -> DataFrame:
    """The written positional index: a segment of documents a row, with (terms, sizes, places)."""
    pack, index = _packed(text), _indexed(vocabulary, text, gap)
    run = index if packed else lambda batches: index(pack(batches))
    return _written(rows.mapInArrow(run, _INDEX_SQL))


def _search(docs: DataFrame, items: DataFrame, text: str, item_key: str, item_text: str, width: int, anchors: int,
            block_words: int, finish: Callable[[Batches], Batches], schema) -> DataFrame:
    """All blocks of the benchmark against the documents, then `finish` over (docs, found, n_words) segments."""
    rows, matched = docs, None
    for part in item_blocks(items, item_key, item_text, block_words):
        block = windows_of(part, width)
        if not len(block):
            continue
        if matched is not None:
            rows = _written(rows.mapInArrow(matched, f"docs binary, found {_FOUND_SQL}, n_words array<int>"))
        rows = postings(rows, block.vocabulary, text, width, matched is not None)
        matched = _matched(block, block.anchors(term_counts(rows, len(block.vocabulary)), anchors), text, width)
    if matched is None:
        pack, index = _packed(text), _indexed(np.zeros(0, np.uint64), text, width)
        return docs.mapInArrow(lambda batches: finish(b.select(["docs", "found", "n_words"]) for b in index(pack(batches))), schema)
    return rows.mapInArrow(lambda batches: finish(matched(batches)), schema)


def find_passages(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
                  item_key: str = "item_id", item_text: str = "text", width: int = WIDTH,
                  anchors: int = ANCHORS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per row of `docs`: n_words, the word spans hit (disjoint, in order) and the items found.

    Returns key, n_words, hits array<struct<start, end>> in word numbers, items array<string>.
    """
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def finish(batches: Batches) -> Batches:
        for batch in batches:
            rows = _documents(batch.column(0)[0])
            spans: list[list] = [[] for _ in range(rows.num_rows)]
            names: list[set] = [set() for _ in range(rows.num_rows)]
            for f in batch.column(1)[0].as_py():
                spans[f["doc"]].append((f["start"], f["end"]))
                names[f["doc"]].update(f["items"])
            hits = []
            for one in spans:
                at = np.array(one, np.int64).reshape(-1, 2)
                a, e = merge_spans(at[:, 0], at[:, 1])
                hits.append([{"start": x, "end": y} for x, y in zip(a.tolist(), e.tolist())])
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), batch.column(2)[0].values.cast(pa.int64()), pa.array(hits, span),
                 pa.array([sorted(n) for n in names], pa.list_(pa.string()))], [key, "n_words", "hits", "items"])

    kind = dict(docs.dtypes)[key]
    return _search(docs.select(key, text), items, text, item_key, item_text, width, anchors, block_words, finish,
                   f"`{key}` {kind}, n_words bigint, hits array<struct<start:bigint,end:bigint>>, items array<string>")


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id",
                      item_text: str = "text", width: int = WIDTH, anchors: int = ANCHORS,
                      block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of `docs`, with all their columns, that hold no window of an item."""
    def finish(batches: Batches) -> Batches:
        for batch in batches:
            rows = _documents(batch.column(0)[0])
            clean = np.ones(rows.num_rows, bool)
            clean[[f["doc"] for f in batch.column(1)[0].as_py()]] = False
            yield rows.filter(pa.array(clean))

    return _search(docs, items, text, item_key, item_text, width, anchors, block_words, finish, docs.schema)


def proximity_matches(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
                      item_text: str = "text", width: int = WIDTH, slop: int = SLOP, anchors: int = ANCHORS,
                      block_words: int = BLOCK_WORDS) -> DataFrame:
    """(key, item): documents where all anchors of a window of the item vote within `slop` of each other."""
    gap, kind, out = width + 2 * slop, dict(docs.dtypes)[key], None
    for part in item_blocks(items, item_key, item_text, block_words):
        block = windows_of(part, width)
        if not len(block):
            continue
        index = postings(docs.select(key, text), block.vocabulary, text, gap)
        chosen = block.anchors(term_counts(index, len(block.vocabulary)), anchors)

        def run(batches: Batches, block: Windows = block, chosen: tuple = chosen) -> Batches:
            windows, terms, offsets = chosen
            for batch, i, lists in _segments(batches, len(block.vocabulary), gap):
                names = _documents(batch.column(0)[i]).column(0)
                pairs = {(d, name) for entry, place in lists.near(terms, offsets, slop)
                         for d, w in set(zip(lists.document(place)[0].tolist(), windows[entry].tolist())) for name in block.owners[w]}
                found = sorted(pairs)
                yield pa.RecordBatch.from_arrays([names.take(pa.array([d for d, _ in found], pa.int64())),
                                                  pa.array([n for _, n in found], pa.string())], [key, "item"])

        here = index.mapInArrow(run, f"`{key}` {kind}, item string")
        out = here if out is None else out.unionByName(here)
    if out is None:
        return docs.sparkSession.createDataFrame([], f"`{key}` {kind}, item string")
    return out.distinct()
