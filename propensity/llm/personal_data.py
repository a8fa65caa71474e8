"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The patterns give the base spans. The field tags the words of each sentence (a line, cut after
words that end in a full stop, exclamation or question mark): its features are the collapsed shape
of a word, digit and letter counts, and the coarse class of its neighbours. It is trained on a small
labelled table of sentences whose words are tagged by base spans, at most SENTENCES of each sort,
from at most DOCUMENTS documents in the order of a hash, and decoded by Viterbi for all sentences
of a block at once. Spans it finds where no base span and no failed match of the kind lies are added;
base spans stay. So that it knows cards in other groupings than the patterns do, some training sentences
are repeated with their cards written with each of SEPARATORS; a card is added if its digits pass the
test of the pattern.

A null text is empty. Rows are independent of each other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.arrow_text import blocks, bytes_of, prefix_sums, span_hashes

DOCUMENTS = 1500  # documents with digits that are looked at for training, at most
FIT_BYTES = 20_000
SENTENCES = 2500  # training sentences with and without personal data, at most
SEPARATORS = [".", "/", "_", "  "]  # of groups of four digits
REWRITTEN = 400  # sentences with a card written in another way, at most
PIECE = 16  # words; longer sentences are cut for training (not for decoding)
STEPS, RATE, PENALTY = 80, 0.1, 1e-4
SHAPES = 4096

KINDS = ["email", "ip", "card", "phone"]
TAGS = ["O", "email", "ip", "card", "card+", "phone", "phone+"]  # + continues a span

# Fixed patterns of the base spans.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _byte_sized(part: str) -> bool:
    p = part.lstrip("0")
    return len(p) <= 3 and int(p or 0) <= 255


def matches(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """((kind, start, end) of the matches that pass their test, of those that fail), by kind, then start.
    Runs of fewer or more digits than a card has are no failed card: a card may be written in such runs."""
    passed: list[tuple[str, int, int]] = []
    failed: list[tuple[str, int, int]] = []

    def put(kind: str, m: re.Match, ok: bool) -> None:
        (passed if ok else failed).append((kind, m.start(), m.end()))

    if "@" in text:
        for m in EMAIL.finditer(text):
            put("email", m, True)
    for m in IP.finditer(text):
        put("ip", m, all(map(_byte_sized, m.group().split("."))))
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "") if m.end() - m.start() >= 16 else ""
        if 16 <= len(digits) <= 19:
            put("card", m, luhn(digits))
    if "+" in text:
        for m in PHONE.finditer(text):
            put("phone", m, 8 <= len(_DIGITS.findall(m.group())) <= 15)
    return passed, failed


def base_spans(text: str) -> list[tuple[str, int, int]]:
    return matches(text)[0]


# ---- words and their features

_CLASS = np.full(256, 9, np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[128:], _CLASS[48:58] = 0, 1, 1, 2
for _n, _c in enumerate(b"@.-+()"):
    _CLASS[_c] = 3 + _n
_ALNUM = _CLASS <= 2


@dataclass
class Sentences:
    """Words (byte spans) of a block, the first word of each sentence, and feature numbers per word."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # sentence s has words first[s]:first[s + 1]
    text: np.ndarray  # text of each word
    features: np.ndarray  # words x features


# feature numbers: shapes, then blocks of small classes
_SIZES = [SHAPES, 10, 10, 4, 8, 8, 8]
_BASE = np.concatenate([[0], np.cumsum(_SIZES)])
WIDTH = int(_BASE[-1])


def sentences(data: np.ndarray, offsets: np.ndarray) -> Sentences:
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:n + 1] = data > 32
    start_of = np.zeros(n + 1, bool)
    start_of[offsets[:-1]] = True
    begins = np.flatnonzero(inside[1:n + 1] & (~inside[:n] | start_of[:n]))
    finish = np.zeros(n + 1, bool)
    finish[offsets[1:]] = True
    ends = np.flatnonzero(inside[1:n + 1] & (~inside[2:] | finish[1:])) + 1
    if not len(begins):
        none = np.zeros(0, np.int64)
        return Sentences(none, none, np.zeros(1, np.int64), none, np.zeros((0, len(_SIZES)), np.int64))
    text = np.searchsorted(offsets, begins, "right") - 1
    cls = _CLASS[data]
    kept = np.zeros(n, bool)
    kept[0:1] = True
    kept[1:] = cls[1:] != cls[:-1]
    kept[begins] = True
    kept &= inside[1:n + 1]
    index = np.concatenate([[0], np.cumsum(kept)])
    shape = span_hashes(prefix_sums(cls[kept]), index[begins], index[ends]) % np.uint64(SHAPES)

    def count(c: int) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(cls == c)])
        return total[ends] - total[begins]

    digits, ats, dots = count(2), count(3), count(4)
    size = ends - begins
    many = np.searchsorted([1, 2, 4, 8, 10, 13, 16, 20], digits, "right")
    long = np.searchsorted([2, 4, 6, 9, 13, 17, 25, 40], size, "right")
    coarse = np.zeros(len(begins), np.int64)
    coarse[digits > 0] = 7
    coarse[(digits > 0) & (cls[begins] == 7)] = 6
    coarse[(digits > 0) & (dots >= 2)] = 4
    coarse[digits == size] = 1
    coarse[(digits == size) & (digits >= 13)] = 2
    coarse[cls[begins] == 6] = 5
    coarse[ats > 0] = 3
    new = np.zeros(len(begins), bool)
    new[0] = True
    new[1:] = text[1:] != text[:-1]
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    new[1:] |= lines[begins[1:]] != lines[begins[:-1]]
    stop = np.isin(data[ends - 1], np.frombuffer(b".!?", np.uint8))
    new[1:] |= stop[:-1]
    before, after = np.zeros_like(coarse), np.zeros_like(coarse)
    before[1:] = np.where(new[1:], 0, coarse[:-1])
    after[:-1] = np.where(new[1:], 0, coarse[1:])
    features = np.stack([shape.astype(np.int64), many, long, np.minimum(ats, 3), coarse, before, after], axis=1) + _BASE[:-1]
    return Sentences(begins, ends, np.append(np.flatnonzero(new), len(begins)), text, features)


# ---- the field

@dataclass
class Field:
    emission: np.ndarray  # features x tags
    transition: np.ndarray  # tags x tags
    start: np.ndarray

    def scores(self, features: np.ndarray) -> np.ndarray:
        out = self.emission[features[:, 0]]
        for c in range(1, features.shape[1]):
            out = out + self.emission[features[:, c]]
        return out

    def decode(self, s: Sentences) -> np.ndarray:
        """Best tag of every word: Viterbi, one step for all sentences that are long enough."""
        score = self.scores(s.features)
        tags = np.zeros(len(s.starts), np.int64)
        length = np.diff(s.first)
        order = np.argsort(-length, kind="stable")
        first, length = s.first[:-1][order], length[order]
        if not len(first):
            return tags
        best = self.start + score[first]
        came = []
        final = np.empty_like(best)
        active = len(first)
        for t in range(1, int(length[0])):
            now = int(np.searchsorted(-length, -t, "left"))  # sentences longer than t
            final[now:active] = best[now:active]
            active = now
            path = best[:now, :, None] + self.transition
            back = path.argmax(axis=1)
            came.append(back.astype(np.uint8))
            best = np.take_along_axis(path, back[:, None, :], axis=1)[:, 0] + score[first[:now] + t]
        final[:active] = best[:active]
        now = final.argmax(axis=1)
        tags[first + length - 1] = now
        for t in range(int(length[0]) - 1, 0, -1):
            n = len(came[t - 1])
            now[:n] = came[t - 1][np.arange(n), now[:n]]
            tags[first[:n] + t - 1] = now[:n]
        return tags


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    m = x.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(features: list[np.ndarray], tags: list[np.ndarray], steps: int = STEPS) -> Field:
    """Maximum likelihood with a ridge penalty: forward-backward over all sentences of one length at
    a time, Adam steps on the whole table."""
    k = len(TAGS)
    field = Field(np.zeros((WIDTH, k)), np.zeros((k, k)), np.zeros(k))
    groups: dict[int, tuple] = {}
    for n in sorted({len(t) for t in tags}):
        some = [i for i, t in enumerate(tags) if len(t) == n]
        groups[n] = (np.stack([features[i] for i in some]), np.stack([tags[i] for i in some]))
    total = sum(len(t) for t in tags)
    flat = np.concatenate([x.reshape(-1, x.shape[2]) for x, _ in groups.values()])
    params = [field.emission, field.transition, field.start]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, steps + 1):
        grads = [np.zeros_like(p) for p in params]
        errors = []
        for n, (x, y) in groups.items():
            score = sum(field.emission[x[:, :, c]] for c in range(x.shape[2]))
            alpha = [field.start + score[:, 0]]
            for t in range(1, n):
                alpha.append(_log_sum(alpha[-1][:, :, None] + field.transition, 1) + score[:, t])
            beta = [np.zeros_like(alpha[0])]
            for t in range(n - 1, 0, -1):
                beta.append(_log_sum(field.transition + (score[:, t] + beta[-1])[:, None, :], 2))
            alpha, beta = np.stack(alpha, 1), np.stack(beta[::-1], 1)
            z = _log_sum(alpha[:, -1], 1)
            error = np.exp(alpha + beta - z[:, None, None]) - (y[:, :, None] == np.arange(k))
            errors.append(error.reshape(-1, k))
            grads[2] += error[:, 0].sum(axis=0)
            pair = np.exp(alpha[:, :-1, :, None] + field.transition + (score[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None])
            grads[1] += pair.sum(axis=(0, 1))
            np.add.at(grads[1], (y[:, :-1].ravel(), y[:, 1:].ravel()), -1)
        error = np.concatenate(errors)
        for c in range(flat.shape[1]):
            for j in range(k):
                grads[0][:, j] += np.bincount(flat[:, c], weights=error[:, j], minlength=WIDTH)
        for p, g, (m, v) in zip(params, grads, moments):
            g = g / total + PENALTY * p
            m *= 0.9
            m += 0.1 * g
            v *= 0.999
            v += 0.001 * g * g
            p -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return field


def code_points(data: np.ndarray) -> np.ndarray:
    """Characters before each byte (and at the end)."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])


def tag_words(s: Sentences, points: np.ndarray, offsets: np.ndarray, spans: list[list[tuple[str, int, int]]]) -> np.ndarray:
    """Tags of words that overlap base spans (spans per text, in code points)."""
    tags = np.zeros(len(s.starts), np.int64)
    bounds = np.searchsorted(s.text, np.arange(len(offsets)))
    for d, found in enumerate(spans):
        a, b = bounds[d], bounds[d + 1]
        begin = points[s.starts[a:b]] - points[offsets[d]]
        end = points[s.ends[a:b]] - points[offsets[d]]
        for kind, x, y in found:
            hit = a + np.flatnonzero((begin < y) & (end > x))
            hit = hit[tags[hit] == 0]
            if len(hit):
                tags[hit] = TAGS.index(kind + "+") if kind in ("card", "phone") else TAGS.index(kind)
                tags[hit[0]] = TAGS.index(kind)
    return tags


def rewritten(texts: list[str], most: int = REWRITTEN, around: int = 60) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """(text, spans): cards of the texts in other groupings, with what stands around them in the line."""
    out: list[tuple[str, list[tuple[str, int, int]]]] = []
    for t in texts:
        spans = base_spans(t)
        for _, x, y in (s for s in spans if s[0] == "card"):
            digits = "".join(_DIGITS.findall(t[x:y]))
            before, after = t[max(0, x - around):x].rpartition("\n")[2], t[y:y + around].partition("\n")[0]
            for mark in SEPARATORS:
                if len(out) == most:
                    return out
                card = mark.join(digits[i:i + 4] for i in range(0, len(digits), 4))
                shift = x - len(before)
                others = [(k, a - shift, b - shift) for k, a, b in spans if shift <= a and b <= x] + [
                    (k, a - y + len(before) + len(card), b - y + len(before) + len(card)) for k, a, b in spans if y <= a and b <= y + len(after)]
                out.append((before + card + after, [("card", len(before), len(before) + len(card)), *others]))
    return out


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", documents: int = DOCUMENTS) -> Field | None:
    """A field trained on a bounded sample; None if it holds no personal data."""
    sample = docs.select(text).filter((F.octet_length(text) <= FIT_BYTES) & F.col(text).rlike("[0-9@]"))
    # copies count once, else a text with many copies could be the whole sample. Only hashes are compared
    # over all rows; texts move once the last hash of the sample is known
    hashes = sample.select(F.xxhash64(text).alias("h"))
    last = [r.h for r in hashes.distinct().orderBy("h").limit(documents).collect()]
    if not last:
        return None
    chosen = sample.filter(F.xxhash64(text) <= max(last)).groupBy(F.xxhash64(text)).agg(F.min(text).alias(text))
    texts = sorted(r[0] for r in chosen.select(text).collect())
    return fit_texts(texts)


def _pieces(texts: list[str], spans: list[list[tuple[str, int, int]]], most: int) -> dict[bool, list]:
    """(features, tags) of pieces of sentences with and without personal data, at most `most` of each."""
    data, offsets = bytes_of(pa.array(texts, pa.string()))
    s = sentences(data, offsets)
    tags = tag_words(s, code_points(data), offsets, spans)
    chosen: dict[bool, list] = {True: [], False: []}
    for first, last in zip(s.first[:-1], s.first[1:]):
        for a in range(first, last, PIECE):
            b = min(a + PIECE, last)
            own = chosen[bool(tags[a:b].any())]
            if len(own) < most:
                own.append((s.features[a:b], tags[a:b]))
    return chosen


def fit_texts(texts: list[str]) -> Field | None:
    """A field trained on the base spans of the texts and on rewritten cards; None without personal data."""
    chosen = _pieces(texts, [base_spans(t) for t in texts], SENTENCES)
    if not chosen[True]:
        return None
    rows = chosen[True] + chosen[False]
    if other := rewritten(texts):
        rows += _pieces([t for t, _ in other], [f for _, f in other], REWRITTEN)[True]
    return train([x for x, _ in rows], [y for _, y in rows])


def _added(s: Sentences, tags: np.ndarray, data: np.ndarray, points: np.ndarray, offsets: np.ndarray, spans: list[list],
           failed: list[list]) -> None:
    """Add the field's spans that touch no base span and no match of their kind that failed its test."""
    word = 0
    marked = np.flatnonzero(tags)
    at = 0
    while at < len(marked):
        word = marked[at]
        kind = TAGS[tags[word]].rstrip("+")
        last = word
        while at + 1 < len(marked) and marked[at + 1] == last + 1 and TAGS[tags[last + 1]] == kind + "+" and s.text[last + 1] == s.text[word]:
            at += 1
            last = marked[at]
        at += 1
        a, b = s.starts[word], s.ends[last]
        inner = np.flatnonzero(_ALNUM[data[a:b]] | (data[a:b] == 43) | (data[a:b] == 40))
        good = np.flatnonzero(_ALNUM[data[a:b]])
        if kind == "card":
            inner = good = np.flatnonzero(_CLASS[data[a:b]] == 2)
            digits = data[a:b][good].tobytes().decode()
            if not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
        if not len(good):
            continue
        a, b = a + inner[0], a + good[-1] + 1
        d = s.text[word]
        x, y = int(points[a] - points[offsets[d]]), int(points[b] - points[offsets[d]])
        if not any(x < e and y > b_ for k, b_, e in spans[d] + [f for f in failed[d] if f[0] == kind]):
            spans[d].append((kind, x, y))


def find_personal_data(docs: DataFrame, field: Field | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, base and spans, both array<struct<kind, start, end>> in code points, by kind and start."""
    kind = dict(docs.dtypes)[key]
    order = {k: i for i, k in enumerate(KINDS)}
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, text, limit=1 << 20):
            base, failed = zip(*(matches(t or "") for t in part.column(1).to_pylist()))
            spans = [list(b) for b in base]
            if field is not None:
                data, offsets = bytes_of(part.column(1))
                s = sentences(data, offsets)
                _added(s, field.decode(s), data, code_points(data), offsets, spans, failed)
            rows = [[[{"kind": k, "start": a, "end": b} for k, a, b in sorted(r, key=lambda x: (order[x[0]], x[1]))] for r in side]
                    for side in (base, spans)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(rows[0], spans_type), pa.array(rows[1], spans_type)], [key, "base", "spans"])

    struct = "array<struct<kind:string,start:bigint,end:bigint>>"
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, base {struct}, spans {struct}")
