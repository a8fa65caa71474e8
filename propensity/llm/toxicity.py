"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary text, one on what toxic text has and
ordinary text has not (words of toxic documents that are rare elsewhere). A window of text is
compressed with the ordinary dictionary alone and with the toxic one in front of it; the bytes
saved by the toxic dictionary are the window's distance. How the savings of all windows of a
document are spread is turned into a probability by a logistic fit on documents that did not
go into the dictionaries; thresholds apply to that probability.

Fitting uses at most SAMPLE documents per class, of at most FIT_BYTES each, in the order of a
hash of their id. Scoring reads whole texts. Only the text is an input of the score. A null
text is an empty one; it has one empty window. Without labels of both classes the score is the
share of the toxic class everywhere.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.arrow_text import blocks

SAMPLE = 4000  # documents per class used for fitting, at most
FIT_BYTES = 20_000
WINDOW = 96  # bytes
LEVEL = 12
ORDINARY_SIZE, TOXIC_SIZE = 112_640, 1_500  # bytes of the dictionaries
RATIO = 8.0  # how much more frequent a word has to be in toxic documents
SHARE = 60  # a word needs one surrounding for so many toxic documents, and LEAST at least
LEAST = 8
THRESHOLD = 0.3
LOW, HIGH = -2, 9  # savings per window that are told apart

_WORD = re.compile(r"[^\W_]+")


def windows(text: str, size: int = WINDOW) -> list[bytes]:
    """The whole lower-cased text in pieces of about `size` bytes that end at white space if they can."""
    raw = text.lower().encode("utf-8", "surrogatepass")
    out, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + size)
        if end < len(raw):
            cut = max(raw.rfind(b" ", at + size // 2, end), raw.rfind(b"\n", at + size // 2, end))
            if cut > 0:
                end = cut + 1
        out.append(raw[at:end])
        at = end
    return out or [b""]


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, source_size=WINDOW, dict_size=len(content), write_content_size=False, write_checksum=False,
        write_dict_id=False)
    return zstandard.ZstdCompressor(compression_params=params, dict_data=zstandard.ZstdCompressionDict(
        content, dict_type=zstandard.DICT_TYPE_RAWCONTENT))


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; too few samples for training are taken as they are."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size] or b" " * 8


def surroundings(texts: list[list[str]]) -> Counter:
    """In how many different surroundings (word before, word after) each word stands; copies count once."""
    places = {(w, a, b) for ws in texts for a, w, b in zip(["", *ws[:-1]], ws, [*ws[1:], ""])}
    return Counter(w for w, _, _ in places)


def toxic_samples(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """Of each toxic document the words that ordinary documents lack."""
    words = [_WORD.findall(t.lower()) for t in toxic]
    here, there = surroundings(words), surroundings([_WORD.findall(t.lower()) for t in ordinary])
    least = max(LEAST, len(toxic) // SHARE)
    own = {w for w, n in here.items() if n >= least
           and (n + 0.5) / len(toxic) >= RATIO * (there[w] + 0.5) / max(1, len(ordinary))}
    lines = [" " + " ".join(w for w in ws if w in own) + " " for ws in words]
    return [s.encode() for s in lines if len(s) > 8]


@dataclass
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray
    share: float

    def scorer(self):
        """A function from text to probability."""
        if not len(self.weights):
            return lambda text: self.share
        plain, with_toxic = compressor(self.ordinary), compressor(self.toxic + self.ordinary)

        def score(text: str) -> float:
            z = float(self.weights @ np.append(1.0, features(text, plain, with_toxic)))
            return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

        return score


def features(text: str, plain, with_toxic) -> np.ndarray:
    saved = np.array([len(plain.compress(w)) - len(with_toxic.compress(w)) for w in windows(text)])
    spread = np.bincount(np.clip(saved, LOW, HIGH) - LOW, minlength=HIGH - LOW + 1) / len(saved)
    return np.concatenate([np.sqrt(spread), [saved.max() / 4, np.log(len(saved)), np.maximum(saved - 2, 0).mean() * 4]])


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Ridge-penalised logistic weights by Newton steps; the first one is the constant."""
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + penalty * np.append(0, w[1:])
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w)), grad)
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, sample: int) -> DataFrame:
    """(label, text) of at most `sample` documents per class; the ids are chosen before texts are read."""
    one = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).alias("y"))
    order = F.xxhash64(F.col(key).cast("string"), F.lit(17))
    chosen = None
    for y in (0, 1):
        part = one.filter(F.col("y") == y).orderBy(order, key).limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    # at most 2 * sample ids: broadcast
    return (docs.select(key, text).filter(F.octet_length(text) <= FIT_BYTES)
            .join(F.broadcast(chosen), key).select(key, "y", text))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        sample: int = SAMPLE) -> ToxicityModel:
    rows = sorted({(int(r[0]), int(r[1]), r[2]) for r in labelled_sample(docs, labels, key, text, label, sample).collect()})
    rows.sort(key=lambda r: (hash_of(r[2]), r[0]))
    share = float(np.mean([y for _, y, _ in rows])) if rows else 0.0
    sides = {y: [t for _, label_, t in rows if label_ == y] for y in (0, 1)}
    if min(len(s) for s in sides.values()) < 6:
        return ToxicityModel(b"", b"", np.zeros(0), share)
    # every third document is kept for the calibration
    train = {y: [t for i, t in enumerate(s) if i % 3] for y, s in sides.items()}
    ordinary = train_dictionary([w for t in train[0] for w in windows(t, 2 * WINDOW)], ORDINARY_SIZE)
    toxic = train_dictionary(toxic_samples(train[1], train[0]), TOXIC_SIZE)
    plain, with_toxic = compressor(ordinary), compressor(toxic + ordinary)
    held = [(t, y) for y, s in sides.items() for i, t in enumerate(s) if i % 3 == 0]
    x = np.array([features(t, plain, with_toxic) for t, _ in held])
    return ToxicityModel(ordinary, toxic, logistic(x, np.array([y for _, y in held], float)), share)


def hash_of(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass"))


def score_documents(docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """Per row: key, score, predicted (1 if score >= threshold)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for part in blocks(batches, text):
            s = [score(t or "") for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(s, pa.float64()), pa.array([int(v >= threshold) for v in s], pa.int32())],
                [key, "score", "predicted"])

    return docs.select(key, text).mapInArrow(run, f"`{key}` {dict(docs.dtypes)[key]}, score double, predicted int")


def drop_toxic(docs: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, with all their columns, that score below the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = model.scorer()
        for part in blocks(batches, text):
            texts = part.column(part.schema.get_field_index(text)).to_pylist()
            yield part.filter(pa.array([score(t or "") < threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
