"""Token files with directly addressable codes.

An id is split into chunks of `CHUNK` bits, lowest first. Level k holds the k-th chunk of every id
that has one, and a bitmap that marks the ids which go on to level k + 1. A rank directory (ones
before each 512-bit block) turns a position of one level into the position of the next, so any
token is read with one step per level and without decoding a block.

A file is a set of segments; a segment is one binary image with its document ids, their first
token, and the levels. Images are rows of a Parquet dataset, so they are written and read by
Spark in any store, in order of (file, segment): ascending document ids. Every segment knows how
many tokens lie before it in its file; a file's own start is a sum over the file totals.

A null text has no tokens but the end id. Rows without id come first. Rows with equal ids are
kept, in the order of their token bytes, each with its own start.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.arrow_text import blocks, bytes_of
from propensity.session import new_path

CHUNK = 8
BLOCK = 512  # bits of a rank block
SEGMENT = 1 << 20  # a segment is closed once it has this many tokens
MAGIC = 0x31434144
MARKS = ".,;:!?*#$%&"  # marks that may end a word and are no letters, digits or apostrophes
CACHE = 500_000  # words in each of the two generations of the encoder's cache
LONGEST = 48
NO_ID = -(1 << 63)


# ---- the code

def pack_ids(ids: np.ndarray) -> bytes:
    """The levels of a list of ids."""
    parts, level = [], ids.astype(np.uint32)
    out = [np.array([len(ids)], np.uint32)]
    while True:
        more = level >= (1 << CHUNK)
        bits = np.packbits(more, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (BLOCK // 8), np.uint8)])
        ones = np.bitwise_count(bits.reshape(-1, BLOCK // 8)).sum(axis=1, dtype=np.uint32)
        rank = np.concatenate([[0], np.cumsum(ones)]).astype(np.uint32)
        parts.append((len(level), (level & ((1 << CHUNK) - 1)).astype(np.uint8), bits, rank))
        level = level[more] >> CHUNK
        if not len(level):
            break
    out.append(np.array([len(parts)] + [p[0] for p in parts], np.uint32))
    body = b"".join(a.tobytes() for _, *arrays in parts for a in arrays)
    return b"".join(a.tobytes() for a in out) + body


class PackedIds:
    """Random access to a packed list."""

    def __init__(self, data: bytes | memoryview):
        head = np.frombuffer(data, np.uint32, 2)
        self.size, levels = int(head[0]), int(head[1])
        sizes = np.frombuffer(data, np.uint32, levels, 8)
        at = 8 + 4 * levels
        self.levels = []
        for n in sizes.tolist():
            chunk = np.frombuffer(data, np.uint8, n, at)
            at += n
            blocks_ = -(-n // BLOCK)
            bits = np.frombuffer(data, np.uint8, blocks_ * BLOCK // 8, at)
            at += len(bits)
            rank = np.frombuffer(data, np.uint32, blocks_ + 1, at)
            at += 4 * len(rank)
            self.levels.append((chunk, bits, rank))

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, i: int) -> int:
        """Token i: one step per level."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        value = shift = 0
        for chunk, bits, rank in self.levels:
            value |= int(chunk[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            first = i // BLOCK * (BLOCK // 8)
            whole = int(np.bitwise_count(bits[first:i >> 3]).sum())
            i = int(rank[i // BLOCK]) + whole + (int(bits[i >> 3]) & ((1 << (i & 7)) - 1)).bit_count()
            shift += CHUNK
        return value

    def slice(self, a: int, b: int) -> np.ndarray:
        """Tokens a to b, with all levels read from where the ranks of `a` point."""
        out = np.zeros(b - a, np.uint32)
        where = np.arange(b - a)
        shift = 0
        for chunk, bits, rank in self.levels:
            if a == b:
                break
            out[where] |= chunk[a:b].astype(np.uint32) << np.uint32(shift)
            flags = np.unpackbits(bits[a >> 3:(b + 7) >> 3], bitorder="little")[a & 7:][:b - a].astype(bool)
            where = where[flags]
            a = self._rank(bits, rank, a)
            b = a + len(where)
            shift += CHUNK
        return out

    @staticmethod
    def _rank(bits: np.ndarray, rank: np.ndarray, i: int) -> int:
        first = i // BLOCK * (BLOCK // 8)
        inside = int(np.bitwise_count(bits[first:i >> 3]).sum())
        rest = (int(bits[i >> 3]) & ((1 << (i & 7)) - 1)).bit_count() if i & 7 else 0
        return int(rank[i // BLOCK]) + inside + rest


def pack_segment(keys: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    head = np.array([MAGIC, len(keys)], np.uint32)
    return b"".join([head.tobytes(), keys.astype("<i8").tobytes(), counts.astype("<u4").tobytes(), pack_ids(ids)])


class Segment:
    """A segment image: its documents and their tokens."""

    def __init__(self, image: bytes | memoryview):
        magic, n = np.frombuffer(image, np.uint32, 2).tolist()
        if magic != MAGIC:
            raise ValueError("not a token segment")
        self.keys = np.frombuffer(image, "<i8", n, 8)
        self.counts = np.frombuffer(image, "<u4", n, 8 + 8 * n).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.ids = PackedIds(memoryview(image)[8 + 12 * n:])

    def document(self, d: int) -> np.ndarray:
        return self.ids.slice(int(self.first[d]), int(self.first[d + 1]))


# ---- encoding with the library

def _words_stand_alone(settings: dict) -> bool:
    """Whether the settings compose, collapse white space, lower-case, and cut at white space, which they drop."""
    steps = (settings.get("normalizer") or {}).get("normalizers", [])
    cuts = (settings.get("pre_tokenizer") or {}).get("pretokenizers", [])
    if [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"] or [c["type"] for c in cuts] != ["Split", "ByteLevel"]:
        return False
    pattern = cuts[0]["pattern"].get("Regex")
    return bool(pattern and cuts[0]["invert"] and cuts[0]["behavior"] == "Removed" and steps[1]["content"] == " "
                and not cuts[1]["add_prefix_space"] and regex.search(pattern, " \t\n\r\x0b\x0c\x85\u00a0\u2003") is None)


class WordEncoder:
    """The tokenizers library, with its results per word kept in a cache of bounded size.

    If the vocabulary's own settings drop white space and lower-case, no token crosses a space or a line end and a
    text's ids are those of its space-separated parts; with other settings whole texts are encoded. A part made of Latin letters and marks after
    them is cut in two, as the vocabulary's own pattern cuts there. Letters-only parts are encoded
    many in one call and told apart by their last token, which ends a word.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.by_word = _words_stand_alone(json.loads(self.library.to_str()))
        vocabulary = self.library.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.last[i] = token.endswith("</w>")
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @staticmethod
    def plain(word: str) -> bool:
        """One run of letters for the library: only letters of ASCII and Latin-1."""
        return word.isalpha() and max(word) < "\u0100"

    def _library_ids(self, words: list[str]) -> list[np.ndarray]:
        found = self.library.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def _encode_new(self, words: list[str]) -> dict[str, bytes]:
        letters = [w for w in words if self.plain(w)]
        out: dict[str, bytes] = {}
        for at in range(0, len(letters), 256):
            group = letters[at:at + 256]
            ids = self._library_ids([" ".join(group)])[0]
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(group):
                out |= {w: i.tobytes() for w, i in zip(group, np.split(ids, ends[:-1]))}
        rest = [w for w in words if w not in out]
        out |= {w: i.tobytes() for w, i in zip(rest, self._library_ids(rest))}
        return out

    def _parts(self, word: str) -> tuple[str, ...]:
        core = word.rstrip(MARKS)
        if len(core) == len(word) or not core or not self.plain(core):
            return (word.lower(),) if self.plain(word) else (word,)
        return core.lower(), word[len(core):]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """The ids of different words, from the cache or the library."""
        young, old = self.young, self.old
        fresh = [w for w in words if w not in young]
        young.update({w: old[w] for w in fresh if w in old})
        cut = {w: self._parts(w) for w in fresh if w not in old}
        parts = {p for ps in cut.values() for p in ps}
        ready = {p: young[p] if p in young else old.get(p) for p in parts}
        ready |= self._encode_new([p for p, ids in ready.items() if ids is None])
        young.update(ready)
        young.update({w: b"".join([ready[p] for p in ps]) for w, ps in cut.items()})
        out = [young[w] for w in words]
        for w in [w for w in {*cut, *parts} if len(w) > LONGEST]:
            del young[w]
        if len(young) >= CACHE:
            self.old, self.young = young, {}
        return out

    def encode_all(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end id, and where each text's ids begin).

        Arrow splits the texts and numbers their different words; ids are gathered by word number.
        """
        texts = texts.fill_null("")
        if self.by_word:
            spaced = pc.replace_substring(texts, "\n", " ")
            lists = pc.split_pattern(spaced, " ")
            coded = lists.flatten().dictionary_encode()
            words, number = self._word_ids(coded.dictionary.to_pylist()), coded.indices.to_numpy(zero_copy_only=False)
            ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        else:
            words = [i.tobytes() for i in self._library_ids(texts.to_pylist())]
            number, ends = np.arange(len(words)), np.arange(1, len(words) + 1)
        pool = np.frombuffer(b"".join(words) + np.uint32(end_id).tobytes(), "<u4")
        size = np.array([*(len(w) // 4 for w in words), 1], np.int64)  # the end id is one more word
        begin = np.cumsum(size) - size
        number = np.insert(number.astype(np.int64), ends, len(words))
        length = size[number]
        stop = np.cumsum(length)
        ids = pool[np.repeat(begin[number] - (stop - length), length) + np.arange(length.sum())]
        return ids, np.concatenate([[0], stop[ends + np.arange(len(ends))]]).astype(np.int64)


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _binary(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """Slices of an array, between the offsets `at`, as binary values."""
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [
        None, pa.py_buffer((at * values.itemsize).astype(np.int64)), pa.py_buffer(values.tobytes())]).cast(pa.binary())


def write_tokens(docs: DataFrame, model: str, end_id: int, key: str = "doc_id", text: str = "text",
                 files: int | None = None, segment: int = SEGMENT) -> str:
    """Encode all rows and write them in ascending key order; returns the dataset's path."""
    spark = docs.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    # cuts between files come from the key column alone; texts are encoded once
    cuts = docs.select(F.col(key).cast("double").alias("k")).approxQuantile(
        "k", [i / files for i in range(1, files)], 0.1 / files) if files > 1 else []
    cuts = np.array(sorted(set(cuts)), float)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        for part in blocks(batches, text, limit=1 << 21):
            keys = part.column(0).cast(pa.int64())
            place = keys.cast(pa.float64(), safe=False).fill_null(-np.inf).to_numpy(zero_copy_only=False)
            ids, at = enc.encode_all(part.column(1), end_id)
            wide = len(ids) > 0 and int(ids.max()) > 0xFFFF
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.searchsorted(cuts, place, "left").astype(np.int32)), keys.fill_null(NO_ID),
                 pa.array([wide] * len(keys)), _binary(ids.astype("<u4" if wide else "<u2"), at)], ["file", "k", "wide", "ids"])

    coded = docs.select(key, text).mapInArrow(encode, "file int, k bigint, wide boolean, ids binary")
    ordered = coded.repartition(files, "file").sortWithinPartitions("file", "k", "ids")
    path = new_path(spark, "tokens")
    ordered.mapInArrow(_packer(segment), "file int, seg int, before bigint, n_docs int, n_tokens bigint, image binary").write.option(
        "compression", "uncompressed").parquet(path)
    return path


def _packer(segment: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        size = seg = before = 0
        file = None

        def close() -> pa.RecordBatch:
            k, c = np.concatenate(keys), np.concatenate(counts)
            row = [file, seg, before, len(k), size, pack_segment(k, c, np.concatenate(ids))]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)],
                                              ["file", "seg", "before", "n_docs", "n_tokens", "image"])

        for part in blocks(batches, "ids", limit=2 * segment):
            data, offsets = bytes_of(part.column(3))
            wide = part.column(2).to_numpy(zero_copy_only=False)
            names = part.column(0).to_numpy()
            k = part.column(1).to_numpy()
            for i in range(part.num_rows):
                if file is not None and (names[i] != file or size >= segment):
                    yield close()
                    before = before + size if names[i] == file else 0
                    seg = seg + 1 if names[i] == file else 0
                    keys, counts, ids, size = [], [], [], 0
                file = int(names[i])
                one = np.frombuffer(data[offsets[i]:offsets[i + 1]].tobytes(), "<u4" if wide[i] else "<u2")
                keys.append(k[i:i + 1].copy())
                counts.append(np.array([len(one)]))
                ids.append(one)
                size += len(one)
        if keys:
            yield close()

    return pack


def file_starts(tokens: DataFrame) -> dict[int, int]:
    """Tokens before each file; as many rows as files."""
    totals = tokens.groupBy("file").agg(F.sum("n_tokens").alias("n")).orderBy("file").collect()
    starts, at = {}, 0
    for r in totals:
        starts[r.file] = at
        at += r.n
    return starts


def read_documents(tokens: DataFrame, key: str = "doc_id", ids: bool = True) -> DataFrame:
    """Per document of the written files: key, start (tokens of all documents before it), n_tokens, ids_crc32 and,
    if asked for, ids binary (little-endian unsigned 32-bit)."""
    starts = file_starts(tokens)
    names = [key, "start", "n_tokens", "ids_crc32"] + ["ids"] * ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, before, image in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                seg = Segment(image.as_buffer())
                values = seg.ids.slice(0, len(seg.ids)).astype("<u4")
                data, at = memoryview(values).cast("B"), (4 * seg.first).tolist()
                crc = [zlib.crc32(data[a:b]) for a, b in zip(at, at[1:])]
                columns = [pa.array(seg.keys, mask=seg.keys == NO_ID), pa.array(starts[file] + before + seg.first[:-1]),
                           pa.array(seg.counts), pa.array(crc, pa.int64())] + [_binary(values, seg.first)] * ids
                yield pa.RecordBatch.from_arrays(columns, names)

    return tokens.select("file", "before", "image").mapInArrow(
        read, f"`{key}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * ids)
