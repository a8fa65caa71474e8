"""Exact encoding with a merge-type piece vocabulary, by backtracking.

A piece vocabulary of the merge type joins, again and again, the adjacent pair whose joined text
has the best score (leftmost on ties). The result is the one token sequence in which every token
is itself the encoding of its text and every two neighbours are the encoding of their joined
text. So it can be found without merging the text:

1. an Aho-Corasick automaton gives the vocabulary pieces that start at each place;
2. the longest piece compatible with the token before it is taken; compatibility of two tokens is
   checked by merging their joined text again, and remembered;
3. where no piece fits, the last token is taken back and its end is marked in a bitfield: the
   encoding of a prefix is unique, so a failed place is never entered a second time.

Two characters that no piece holds side by side can never be joined; texts are cut there first
(between words, around line ends and unknown characters), and the encodings of the parts are
kept in a cache of bounded size. Characters without a piece become byte tokens.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from propensity.llm.arrow_text import blocks

SPACE = "▁"
CACHE = 300_000  # words in each of the two generations of the cache
LONGEST = 48  # longer words are encoded each time


class PieceEncoder:
    """Encodes text to ids and ids to text with the vocabulary file at `path`."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()
        self.pieces, self.scores, self.bytes = {}, {}, {}
        self.automaton = ahocorasick.Automaton()
        self.joinable: set[str] = set()
        for i in range(size):
            piece = self.library.id_to_piece(i)
            if self.library.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_unused(i)):
                self.pieces[piece] = i
                self.scores[piece] = self.library.get_score(i)
                self.automaton.add_word(piece, piece)
                self.joinable.update(piece[k:k + 2] for k in range(len(piece) - 1))
        self.automaton.make_automaton()
        self.compatible: dict[tuple[str, str], bool] = {}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        # words may be encoded one by one if a word never joins with the space after it
        self.word_cut = not any(pair[1] == SPACE and pair[0] != SPACE for pair in self.joinable)

    def merge(self, text: str) -> list[str]:
        """The definition: join the best adjacent pair until none is left (for short texts)."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, left: str, right: str) -> bool:
        """Whether the two tokens stay as they are next to each other ('' is the start)."""
        known = self.compatible.get((left, right))
        if known is None:
            known = self.merge(left + right) == ([left, right] if left else [right])
            if len(self.compatible) >= 4 * CACHE:
                self.compatible.clear()
            self.compatible[left, right] = known
        return known

    def backtrack(self, text: str) -> list[str]:
        """The encoding of a text without unknown characters."""
        starts: list[list[str]] = [[] for _ in text]
        for last, piece in self.automaton.iter(text):
            starts[last - len(piece) + 1].append(piece)  # shortest first, as ends ascend
        failed = bytearray(len(text) + 1)
        tokens: list[str] = []
        tried = [len(starts[0])]  # candidates of the open place that are still to try
        at = 0
        while at < len(text):
            before = tokens[-1] if tokens else ""
            options, k = starts[at], tried[-1]
            while k:
                k -= 1
                piece = options[k]
                end = at + len(piece)
                # one token must be its own encoding, two neighbours that of their joined text
                if not failed[end] and self.fits("", piece) and (not before or self.fits(before, piece)):
                    break
            else:
                failed[at] = 1
                if not tokens:
                    raise ValueError("no encoding")
                tried.pop()
                at -= len(tokens.pop())
                continue
            tried[-1] = k
            tokens.append(piece)
            at = end
            if at < len(text):
                tried.append(len(starts[at]))
        return tokens

    def part_ids(self, part: str) -> list[int]:
        """Ids of a text cut where its characters cannot be joined."""
        out: list[int] = []
        a = 0
        for b in range(1, len(part) + 1):
            if b < len(part) and part[b - 1:b + 1] in self.joinable:
                continue
            unit, a = part[a:b], b
            if unit in self.pieces and self.fits("", unit):
                out.append(self.pieces[unit])
            elif len(unit) == 1:
                out += [self.bytes[x] for x in unit.encode()]
            else:
                out += [self.pieces[t] for t in self.backtrack(unit)]
        return out

    def word(self, word: str) -> bytes:
        """Ids (32-bit little-endian) of a word with the space before it."""
        got = self.old.get(word)
        if got is None:
            got = np.array(self.part_ids(SPACE + word), "<u4").tobytes()
        if len(word) <= LONGEST:
            if len(self.young) >= CACHE:
                self.old, self.young = self.young, {}
            self.young[word] = got
        return got

    def encode(self, text: str) -> np.ndarray:
        """Ids with begin and end."""
        edge = (np.array([self.begin], "<u4").tobytes(), np.array([self.end], "<u4").tobytes())
        if not text:
            return np.frombuffer(b"".join(edge), "<u4")
        if not self.word_cut:
            body = [np.array(self.part_ids(SPACE + text.replace(" ", SPACE)), "<u4").tobytes()]
        elif SPACE in text or "  " in text or text[-1] == " " or text[0] == " ":
            body = [np.array(self.part_ids(w), "<u4").tobytes()
                    for w in re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", SPACE + text.replace(" ", SPACE))]
        else:
            words = text.split(" ")
            young = self.young
            body = list(map(young.get, words))
            if None in body:
                for i, b in enumerate(body):
                    if b is None:
                        body[i] = self.young.get(words[i]) or self.word(words[i])
        return np.frombuffer(b"".join((edge[0], *body, edge[1])), "<u4")

    def decode(self, rows: list[list[int]]) -> list[str]:
        return self.library.decode(rows)


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder per Python process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def encode_documents(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text",
                     ids: bool = True) -> DataFrame:
    """Per row: its key, `n_tokens`, `ids_sha256`, `decoded_sha256`, and with `ids` the tokens and
    the decoded text (`ids` array<int>, `decoded` string).

    A null text is encoded as the empty text: begin and end only. Rows are independent: repeated
    rows and keys, null keys and further columns are fine. `model` is a path that executors see.
    """
    kind = dict(docs.dtypes)[key]
    more = ", ids array<int>, decoded string" if ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        for part in blocks(batches, text, limit=1 << 20):
            encoded = [enc.encode(t or "") for t in part.column(1).to_pylist()]
            decoded = enc.decode([e.tolist() for e in encoded])
            columns = [
                part.column(0), pa.array([len(e) for e in encoded], pa.int64()),
                pa.array([hashlib.sha256(e.tobytes()).hexdigest() for e in encoded]),
                pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded])]
            names = [key, "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                columns += [pa.array([e.astype(np.int32) for e in encoded], pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string{more}")
