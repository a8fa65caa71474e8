"""Secret scans over a trigram inverted index.

Every rule is a regular expression. Its parse tree gives a Boolean query over trigrams that
any matching text must satisfy (AND of ORs of trigrams). Documents are indexed in segments:
one posting list of document numbers per (segment, trigram). A rule's candidates are the
intersections and unions of posting lists; only candidates are verified with the expression.
A rule without a mandatory trigram scans its segment fully.

Letters are folded to lower case in the index, which only widens the candidate sets. Segments
are slices of a partition, so there is no shuffle, no hot posting list and no per-group state.
A null text is an empty text. Rows may repeat: every row gives one result row.
"""

from __future__ import annotations

import re
import re._constants as rc
import re._parser as rp
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from propensity.llm.arrow_text import LOWER, blocks, bytes_of, merge_spans, runs

# A trigram query is True (no condition), or ("and" | "or", frozenset of queries), or a trigram.
SET_LIMIT = 64  # alternatives of exact strings kept before they are turned into a query


@dataclass(frozen=True)
class Rule:
    """A kind of secret: an expression, and a test that a match must pass (else it is dropped)."""

    kind: str
    pattern: str
    accept: Callable[[re.Match], bool] | None = None

    @cached_property
    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII)

    @cached_property
    def query(self):
        return trigram_query(self.pattern)


def _fold(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def _join(op: str, parts: Iterable):
    """AND or OR with constants removed and equal kinds flattened."""
    flat = set()
    for p in parts:
        if p is True:
            if op == "or":
                return True
            continue
        if isinstance(p, tuple) and p[0] == op:
            flat |= p[1]
        else:
            flat.add(p)
    if not flat:
        return True
    if op == "or":  # an alternative that asks for more than another one adds nothing
        terms = {f: f[1] if isinstance(f, tuple) and f[0] == "and" else frozenset([f]) for f in flat}
        flat = {f for f in flat if not any(o != f and terms[o] < terms[f] for o in flat)}
    return next(iter(flat)) if len(flat) == 1 else (op, frozenset(flat))


def _needs(strings: set[str]):
    """The query of a text that holds one of the strings."""
    def one(s: str):
        raw = s.encode()
        return _join("and", [raw[i:i + 3] for i in range(len(raw) - 2)])
    return _join("or", [one(s) for s in strings]) if strings else True


def trigram_query(pattern: str):
    """Boolean trigram query of a regular expression, over text folded to lower case."""
    exact, query = _walk(list(rp.parse(pattern, re.ASCII)))
    return query if exact is None else _join("and", [query, _needs(exact)])


def _walk(items: list) -> tuple[set[str] | None, object]:
    """(all strings the items can match, or None; the query of everything before)."""
    exact: set[str] | None = {""}
    query: object = True
    for op, arg in items:
        part, own = _item(op, arg)
        query = _join("and", [query, own])
        if part is None:
            query = _join("and", [query, _needs(exact or {""})])
            exact = {""}
            continue
        if len(exact) * len(part) > SET_LIMIT:
            query = _join("and", [query, _needs(exact)])
            exact = {""}
        # strings of earlier items stay joined to these, so trigrams across items count
        exact = {a + b for a in exact for b in part} if len(part) <= SET_LIMIT else {""}
    return exact, query


def _item(op, arg) -> tuple[set[str] | None, object]:
    if op is rc.LITERAL:
        return {_fold(chr(arg))}, True
    if op is rc.IN:
        chars = _class(arg)
        return (chars, True) if chars and len(chars) <= 8 else (None, True)
    if op is rc.SUBPATTERN:
        return _walk(list(arg[3]))
    if op is rc.BRANCH:
        walked = [_walk(list(b)) for b in arg[1]]
        if all(e is not None and q is True for e, q in walked):
            strings = set().union(*(e for e, _ in walked))
            if len(strings) <= SET_LIMIT:
                return strings, True
        return None, _join("or", [_join("and", [q, _needs(e) if e else True]) for e, q in walked])
    if op in (rc.MAX_REPEAT, rc.MIN_REPEAT):
        low, high, body = arg
        strings, query = _walk(list(body))
        if low == 0:
            return ({""} | strings, True) if high == 1 and strings and query is True else (None, True)
        if low == high == 1:
            return strings, query
        return None, _join("and", [query, _needs(strings) if strings else True])
    if op is rc.AT:
        return {""}, True
    return None, True


def _class(items) -> set[str] | None:
    out: set[str] = set()
    for op, arg in items:
        if op is rc.LITERAL:
            out.add(_fold(chr(arg)))
        elif op is rc.RANGE and arg[1] - arg[0] < 8:
            out |= {_fold(chr(c)) for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return out


def trigrams_in(query) -> set[bytes]:
    if query is True:
        return set()
    if isinstance(query, bytes):
        return {query}
    return set().union(*(trigrams_in(q) for q in query[1]))


def _code(gram: bytes) -> int:
    return gram[0] << 16 | gram[1] << 8 | gram[2]


class Segment:
    """Posting lists (sorted document numbers) of one slice of texts for a set of trigrams."""

    def __init__(self, column: pa.Array, vocabulary: np.ndarray):
        raw, offsets = bytes_of(column)
        self.size = len(offsets) - 1
        self.postings: dict[int, np.ndarray] = {}
        if len(raw) < 3 or not len(vocabulary):
            return
        data = LOWER[raw].astype(np.int32)
        codes = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
        wanted = np.zeros(1 << 24, bool)
        wanted[vocabulary] = True
        at = np.flatnonzero(wanted[codes])
        doc = np.searchsorted(offsets, at, "right") - 1
        inside = at + 3 <= offsets[doc + 1]  # not across two documents
        pairs = np.unique(codes[at[inside]].astype(np.int64) << 32 | doc[inside])
        grams = pairs >> 32
        edge = runs(grams)
        for a, b in zip(edge[:-1], edge[1:]):
            if b > a:
                self.postings[int(grams[a])] = pairs[a:b] & 0xFFFFFFFF

    def matching(self, query) -> np.ndarray:
        """Numbers of the documents that satisfy the query."""
        if query is True:
            return np.arange(self.size)
        if isinstance(query, bytes):
            return self.postings.get(_code(query), np.zeros(0, np.int64))
        lists = sorted((self.matching(q) for q in query[1]), key=len)
        if query[0] == "and":
            return reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True), lists)
        return reduce(np.union1d, lists)


def trigram_postings(docs: DataFrame, rules: list[Rule], key: str = "doc_id", text: str = "text") -> DataFrame:
    """The index as a table: (trigram, docs array<bigint>), one row per segment and trigram."""
    grams = sorted(set().union(*(trigrams_in(r.query) for r in rules)))
    codes = np.array([_code(g) for g in grams], np.int64)
    names = {_code(g): g for g in grams}

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, text):
            ids = part.column(0)
            found = Segment(part.column(1), codes).postings
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[c] for c in found], pa.binary()),
                 pa.array([ids.take(pa.array(p)).to_pylist() for p in found.values()], pa.list_(pa.int64()))],
                ["trigram", "docs"])

    return docs.select(key, text).mapInArrow(index, "trigram binary, docs array<bigint>")


def find_secrets(docs: DataFrame, rules: list[Rule], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of `docs`: its key and the spans found, array<struct<kind, start, end>> in code points.

    Spans of one kind do not overlap; they are ordered by start, then in the order of the rules.
    """
    codes = np.array(sorted({_code(g) for r in rules for g in trigrams_in(r.query)}), np.int64)
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, text):
            spans = [[{"kind": k, "start": s, "end": e} for s, e, k in row] for row in scan_segment(part.column(1), rules, codes)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, _SPANS)], [key, "spans"])

    kind = dict(docs.dtypes)[key]
    return docs.select(key, text).mapInArrow(
        scan, f"`{key}` {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def scan_segment(texts: pa.Array, rules: list[Rule], codes: np.ndarray) -> list[list[tuple[int, int, str]]]:
    """(start, end, kind) of the spans of each text, found through the segment's posting lists."""
    segment = Segment(texts, codes)
    read: dict[int, str] = {}
    found: list[list] = [[] for _ in range(len(texts))]
    for rank, rule in enumerate(rules):
        for d in segment.matching(rule.query).tolist():
            if d not in read:
                read[d] = texts[d].as_py() or ""
            for m in rule.compiled.finditer(read[d]):
                if rule.accept is None or rule.accept(m):
                    found[d].append((m.start(), rank, m.end(), rule.kind))
    return [[(s, e, k) for s, _, e, k in sorted(row)] for row in found]


def redact_secrets(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """`docs` with every span found (overlapping ones as one) replaced by `[secret]`; null stays null."""
    codes = np.array(sorted({_code(g) for r in rules for g in trigrams_in(r.query)}), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, text):
            place = part.schema.get_field_index(text)
            column = part.column(place)
            clean = column.to_pylist()
            for d, row in enumerate(scan_segment(column, rules, codes)):
                if row:
                    at = np.array([(s, e) for s, e, _ in row])
                    for s, e in reversed(list(zip(*merge_spans(at[:, 0], at[:, 1])))):
                        clean[d] = clean[d][:s] + "[secret]" + clean[d][e:]
            yield part.set_column(place, part.schema.field(place), pa.array(clean, column.type))

    return docs.mapInArrow(run, docs.schema)


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

# Fixed values of the base rules: keyword letters in either case, ASCII only.
_KEYWORDS = "password|passwd|secret|token|api_?key"
_EITHER = re.sub("[a-z]", lambda m: f"[{m[0].upper()}{m[0]}]", _KEYWORDS)
ASSIGN = rf"""({_EITHER})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def long_enough(group: int, size: int) -> Callable[[re.Match], bool]:
    return lambda m: m.end(group) - m.start(group) >= size


BASE_RULES = [
    Rule("assign", ASSIGN, long_enough(2, 12)),
    Rule("access", "AKIA[A-Z0-9]+", long_enough(0, 18)),
    # runs of at least 16 are exactly the runs of one or more that pass the length test
    Rule("hex", "[0-9a-f]{16,}"),
]
# Further kinds with public, documented prefixes.
MORE_RULES = [
    Rule("private_key", "-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("git_token", "gh[oprsu]_[A-Za-z0-9]{30,}"),
    Rule("chat_token", "xox[abprs]-[A-Za-z0-9-]{10,}"),
]
RULES = BASE_RULES + MORE_RULES
