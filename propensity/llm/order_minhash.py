"""Near-duplicates with Order MinHash and banded alignment.

Texts are sequences of words (lower-cased runs of letters, digits and non-ASCII characters) and
their k-mers are shingles of five words, each labelled with its occurrence number in the text.
One sketch is the `LENGTH` k-mers with the smallest hash values, kept in the order of the text;
two texts agree in a sketch if they share these k-mers in the same order, which is likelier the
smaller their edit distance is. Texts that agree in one of `SKETCHES` sketches are candidates.

A candidate pair is aligned word by word inside the band of diagonals that a similar pair cannot leave.
Pairs are linked whose edit similarity, 1 - distance / words of the longer text, is `least` or more, and
whose labelled shingles have a Jaccard similarity of `shingles` or more. op1 and the pipeline ask for 0.8 in
both, which is the default; with `shingles=0` only the edit similarity counts. A pair with shingle similarity J is a candidate with
probability 1 - (1 - J^3)^12: 0.9998 at 0.8. Pairs that edit similarity alone would link have a far smaller J (0.2 at
an edit similarity of 0.8 by scattered substitutions) and are mostly missed. Texts whose passages changed places have
a high J but a low edit similarity: they are not linked.

Equal word sequences are one text with a class of copies from the start. Of buckets with more than `SMALL`
members, most members may share a template and yet not link. So their texts are dealt anew, by an exact prefix filter: with the
labelled shingles of each text ordered rarest first, two texts with a Jaccard similarity of s share one of the first
m - ceil(s m) + 1 of their m shingles; and where they share the first one, enough shingles must be left behind it in
both. Rarity comes from a histogram of a fixed number of slots; any order is exact, a rarer one only makes buckets smaller. Shingles that
no second prefix has are dropped before they become rows, and a pair is made only if the parities of its shingles allow the similarity. No pair that
reaches the shingle similarity is lost. Without a shingle similarity the buckets stay as they are and are split by further sketches.

Buckets are worked off in rounds: the members that are not yet in the class of the bucket's leaders are compared with
these, small buckets are compared pair by pair, and what was linked counts as one class. A bucket of
many copies costs a few comparisons per member; leaders multiply from round to round, so rounds are few. The rounds go
on until no bucket holds two classes that were not compared.

A text without words (null and empty ones too) is a copy only of rows with the same text; null counts
as empty. Rows without id are classes of their own and keep no one else from staying.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensity.llm.arrow_text import Words, blocks, mix
from propensity.llm.components import components
from propensity.session import keep

SHINGLE = 5
SIMILARITY = 0.8
LENGTH = 3  # k-mers of a sketch
SKETCHES = 12
LEADERS = 4  # of a large bucket in the first round; 64 times as many in each further one
SMALL = 40  # members of a bucket that are compared pair by pair
REFINE = (2, 4)  # rounds after which, without a shingle similarity, the large buckets left are split by a further sketch
SLOTS = 1 << 18  # of the histogram of shingles
OUTLINE = 256  # counts in the outline of a text
PARITY = 16  # words of 64 bits in the parities of a text
MARKS = 1 << 25  # slots that tell the rows whose words are compared, and the shingles that several prefixes have
PART = 1 << 16  # slots that are counted together
_SALTS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_hashes(words: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Hashes of consecutive words; a shorter text is one shingle of all its words."""
    n = max(1, len(words) - width + 1)
    out = np.full(n, len(words) if len(words) < width else width, np.uint64)
    for i in range(min(width, len(words))):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[i:i + n])
    return out


def labelled(hashes: np.ndarray) -> np.ndarray:
    """Hashes with the occurrence number mixed in: the first, second, ... of equal ones differ."""
    order = np.argsort(hashes, kind="stable")
    s = hashes[order]
    new = np.concatenate([[True], s[1:] != s[:-1]])
    first = np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
    number = np.empty(len(s), np.uint64)
    number[order] = (np.arange(len(s)) - first).astype(np.uint64)
    return mix(hashes + number * np.uint64(0xD6E8FEB86659FD93))


def sketch(words: np.ndarray, sketches: int = SKETCHES, length: int = LENGTH) -> np.ndarray:
    """One 64-bit value per sketch: its k-mers of smallest hash, in text order."""
    kmers = labelled(shingle_hashes(words))
    if len(kmers) > length:
        at_once = max(1, (1 << 20) // len(kmers))
        place = np.concatenate([
            np.sort(np.argpartition(mix(kmers[None, :] ^ _SALTS[r:min(r + at_once, sketches), None]), length - 1, axis=1)[:, :length], axis=1)
            for r in range(0, sketches, at_once)])
    else:
        place = np.tile(np.arange(len(kmers)), (sketches, 1))
    value = np.full(sketches, place.shape[1], np.uint64)
    for c in range(place.shape[1]):
        value = mix(value * np.uint64(0x9E3779B97F4A7C15) + kmers[place[:, c]])
    return value


def banded_distance(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """Edit distance (substitute, insert, delete), or None if it is over `most`.

    Bit-parallel alignment inside the band of 2 * most + 1 diagonals: one integer holds the differences
    between neighbouring cells of a column, and moves down with the band from word to word of b.
    """
    if len(a) < len(b):
        a, b = b, a
    n, m = len(a), len(b)
    most = min(most, n)
    if n - m > most:
        return None
    if not m:
        return n
    places: dict[int, int] = {}
    for i, w in enumerate(a.tolist()):
        places[w] = places.get(w, 0) | 1 << i
    width = 2 * most + 2
    full = (1 << width) - 1
    low = 1 << (width - 1)  # the lowest diagonal of the band
    up = full ^ ((1 << (width - most - 1)) - 1)  # vertical differences of +1
    down = 0  # and of -1
    start = most + 1 - width  # word of a at the band's first bit
    at = most  # distance in the cell that is followed: down the lowest diagonal, then along the last row
    row = width - 2
    for i, w in enumerate(b.tolist()):
        here = places.get(w, 0)
        match = (here >> start if start >= 0 else here << -start) & full
        zero = ((((match & up) + up) ^ up) | match | down) & full  # diagonal differences of 0
        right_up = down | (full ^ (zero | up))
        right_down = zero & up
        if i < n - most:
            if not zero & low:
                at += 1
        else:
            at += (right_up >> row & 1) - (right_down >> row & 1)
            row -= 1
        if at > 2 * most + m - n:
            return None
        shifted = zero >> 1
        up = right_down | (full ^ (shifted | right_up))
        down = shifted & right_up
        start += 1
    return at if at <= most else None


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """1 - edit distance / words of the longer text; 0.0 if it is below `least`."""
    longer = max(len(a), len(b))
    found = banded_distance(a, b, int((1 - least) * longer + 1e-9))
    return 0.0 if found is None else 1 - found / longer


def shingle_similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Jaccard similarity of the labelled shingles; 0.0 if it is below `least`."""
    na, nb = max(1, len(a) - SHINGLE + 1), max(1, len(b) - SHINGLE + 1)
    if min(na, nb) < least * max(na, nb):
        return 0.0
    shared = len(np.intersect1d(labelled(shingle_hashes(a)), labelled(shingle_hashes(b)), assume_unique=True))
    found = shared / (na + nb - shared)
    return found if found >= least else 0.0


def outline(words: np.ndarray) -> bytes | None:
    """Labelled shingles counted by a part of their hash, a byte each; None where a byte is too small. The smaller
    counts of two texts add up to at least the shingles they share."""
    n = np.bincount((labelled(shingle_hashes(words)) >> np.uint64(48)).astype(np.int64) % OUTLINE, minlength=OUTLINE)
    return n.astype(np.uint8).tobytes() if n.max() < 256 else None


def parity(words: np.ndarray) -> np.ndarray:
    """Whether labelled shingles are odd or even in number, a bit for each part of their hash. Each shingle that only one of
    two texts has changes one bit, so they have at least as many such shingles as bits that differ."""
    n = np.bincount((labelled(shingle_hashes(words)) >> np.uint64(40)).astype(np.int64) % (64 * PARITY), minlength=64 * PARITY)
    return np.packbits((n & 1).astype(np.uint8)).view(np.int64)


def linked(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY, shingles: float = 0.0) -> float:
    """Edit similarity if it reaches `least` and the shingles reach `shingles`, else 0.0. Shingles are
    looked at first, as they cost less than the alignment."""
    if shingles > 0 and not shingle_similarity(a, b, shingles):
        return 0.0
    return similarity(a, b, least)


def sketched(docs: DataFrame, key: str, text: str, sketches: int, length: int) -> DataFrame:
    """(id, same, n_words, keys): a digest of the word sequence and the sketches of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, text):
            words = Words(part.column(1))
            same, size, keys = [], np.diff(words.bounds), []
            raw = None
            for d in range(part.num_rows):
                h = words.hashes[words.bounds[d]:words.bounds[d + 1]]
                if len(h):
                    same.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest())
                    keys.append(sketch(h, sketches, length).astype(np.int64))
                else:
                    raw = part.column(1)[d].as_py() or ""
                    same.append(hashlib.blake2b(b"\0" + raw.encode("utf-8", "surrogatepass"), digest_size=16).digest())
                    keys.append(np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(same, pa.binary()), pa.array(size, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                ["id", "same", "n_words", "keys"])

    return docs.select(F.col(key).cast("bigint").alias("id"), text).filter("id is not null").mapInArrow(
        run, "id bigint, same binary, n_words bigint, keys array<bigint>")


def _marks(ids: DataFrame) -> np.ndarray:
    """One bit for each of MARKS slots: whether an id of the column `id` has it. Bits are set where the slots were sent to."""
    slots = ids.select(_mark(F.col("id")).alias("slot")).select("slot", F.bitmap_bucket_number("slot").alias("part")).repartition("part")
    found = slots.groupBy("part").agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).toArrow()
    out = np.zeros((MARKS // 32768, 4096), np.uint8)
    for part, bits in zip(*found.columns):
        out[part.as_py() - 1] = np.frombuffer(bits.as_buffer(), np.uint8)
    return out.ravel()


def _mark(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(MARKS)) + 1


def word_rows(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """(id, words binary, outline binary, parity array<bigint>): the word hashes of the wanted ids, one row per id. Texts are not shuffled: rows whose
    slot no wanted id has are dropped where they are read, and the few others that are not wanted by the join."""
    marks = _marks(wanted)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(2).to_numpy() - 1
            yield batch.filter(pa.array((marks[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(marked(batches), text):
            words = Words(part.column(1))
            each = [words.hashes[a:b] for a, b in zip(words.bounds[:-1], words.bounds[1:])]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([w.tobytes() for w in each], pa.binary()),
                                              pa.array([outline(w) for w in each], pa.binary()),
                                              pa.array([parity(w) for w in each], pa.list_(pa.int64()))], ["id", "words", "outline", "parity"])

    rows = docs.select(F.col(key).cast("bigint").alias("id"), text).withColumn("slot", _mark(F.col("id")))
    return (rows.mapInArrow(run, "id bigint, words binary, outline binary, parity array<bigint>").join(wanted, "id", "left_semi").groupBy("id")
            .agg(F.min(F.struct("words", "outline", "parity")).alias("w")).select("id", "w.*"))


def _possible(pairs: DataFrame, words: DataFrame, shingles: float) -> DataFrame:
    """The pairs whose outlines leave the shingle similarity possible; none that has it is lost."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = np.array(batch.column(2).is_valid()) & np.array(batch.column(3).is_valid())
            x, y = (np.frombuffer(b"".join(c.filter(pa.array(known)).to_pylist()), np.uint8).reshape(-1, OUTLINE) for c in batch.columns[2:])
            need = shingles / (1 + shingles) * (x.sum(axis=1, dtype=np.int64) + y.sum(axis=1, dtype=np.int64))
            stay = ~known
            stay[known] = np.minimum(x, y).sum(axis=1, dtype=np.int64) >= need - 1e-6
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(stay)) for c in batch.columns[:2]], ["a", "b"])

    joined = (pairs.join(words.select(F.col("id").alias("a"), F.col("outline").alias("oa")), "a")
              .join(words.select(F.col("id").alias("b"), F.col("outline").alias("ob")), "b"))
    return joined.select("a", "b", "oa", "ob").mapInArrow(run, "a bigint, b bigint")


def _verified(pairs: DataFrame, words: DataFrame, least: float, shingles: float) -> DataFrame:
    """The pairs (a, b) that are linked, with their edit similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            s = np.array([linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), least, shingles)
                          for x, y in zip(left, right)])
            ok = pa.array(s >= least)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(ok), batch.column(1).filter(ok), pa.array(s).filter(ok)], ["a", "b", "similarity"])

    if shingles > 0:
        pairs = keep(_possible(pairs, words, shingles))
    joined = (pairs.join(words.select(F.col("id").alias("a"), F.col("words").alias("wa")), "a")
              .join(words.select(F.col("id").alias("b"), F.col("words").alias("wb")), "b"))
    return joined.select("a", "b", "wa", "wb").mapInArrow(run, "a bigint, b bigint, similarity double")


def find_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = SIMILARITY,
                sketches: int = SKETCHES, length: int = LENGTH, shingles: float = SIMILARITY) -> DataFrame:
    """Per row of `docs` with an id: key, component_id (smallest id of its class), copy_of (smallest id
    with the same words), kept (it is the smallest). Repeated ids give one row. `shingles` is the
    shingle similarity that a link needs besides the edit similarity `least`; 0 asks for none."""
    rows = keep(sketched(docs, key, text, sketches, length))
    # copies first: minima combine before the shuffle, so a hot text is no burden. Aggregates are
    # written before they are joined, so that a hot key of the other side can be split
    first = keep(rows.groupBy("same").agg(F.min("id").alias("copy_of")))
    copies = keep(rows.groupBy("id").agg(F.min("same").alias("same")).join(first, "same").select("id", "copy_of"))
    texts = keep(rows.filter("n_words > 0").join(copies.filter("id = copy_of").select("id"), "id", "left_semi")
                 .dropDuplicates(["id"]).select("id", "keys"))
    members = texts.select("id", F.posexplode("keys").alias("number", "value")).select(
        "id", F.xxhash64("number", "value").alias("bucket"))
    members = _shared(members.distinct().withColumn("m", F.lit(0)).withColumn("rest", F.lit(0)))
    words = keep(word_rows(docs, members.select("id").distinct(), key, text))
    if shingles > 0:
        members = _by_prefix(members, words, shingles)
    links = labels = asked = led = None
    turn = 0
    while True:
        now = _with_labels(members, labels)
        pairs, leaders = _round_pairs(now, led, LEADERS << 6 * min(turn, 4), shingles, words)
        if asked is not None:
            pairs = pairs.join(asked, ["a", "b"], "left_anti")
        leaders = keep(leaders)
        pairs = keep(pairs)
        if not leaders.limit(1).count() and not pairs.limit(1).count():
            break
        # each round's part is written once; the history is the union of these files
        asked = pairs if asked is None else asked.unionByName(pairs)
        led = leaders if led is None else led.unionByName(leaders)
        new = keep(_verified(pairs, words, least, shingles).select("a", "b"))
        links = new if links is None else links.unionByName(new)
        labels = keep(components(links))
        turn += 1
        if turn in REFINE and not shingles > 0:
            members = _refined(_with_labels(members, labels), texts)
    if labels is None:
        out = copies.withColumn("component", F.col("copy_of"))
    else:
        named = labels.select(F.col("id").alias("copy_of"), "component")
        out = copies.join(named, "copy_of", "left").withColumn("component", F.coalesce("component", "copy_of"))
    return out.select(F.col("id").alias(key), F.col("component").alias("component_id"), "copy_of",
                      (F.col("id") == F.col("component")).alias("kept"))


def _shared(members: DataFrame) -> DataFrame:
    """Members of the buckets that have more than one."""
    sizes = keep(members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket"))
    return keep(members.join(sizes, "bucket"))


def _histogram(words: DataFrame) -> np.ndarray:
    """Labelled shingles of all texts, counted by hash in SLOTS slots; at most that many rows come to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            for x in batch.column(0):
                h = labelled(shingle_hashes(np.frombuffer(x.as_buffer(), np.uint64)))
                np.add.at(total, (h % np.uint64(SLOTS)).astype(np.int64), 1)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], ["slot", "n"])

    counts = words.select("words").mapInArrow(run, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SLOTS, np.int64)
    out[counts.column("slot").to_numpy()] = counts.column("n").to_numpy()
    return out


def prefix(words: np.ndarray, often: np.ndarray, shingles: float) -> tuple[np.ndarray, int]:
    """(the shingles of the prefix, rarest first; the number of all shingles)."""
    h = labelled(shingle_hashes(words))
    m = len(h)
    order = np.lexsort((h, often[(h % np.uint64(len(often))).astype(np.int64)]))
    return h[order[:m - math.ceil(shingles * m - 1e-6) + 1]], m


def _repeated(texts: DataFrame, often: np.ndarray, shingles: float) -> np.ndarray:
    """One bit for each of MARKS slots: whether two or more shingles of the prefixes have it. Tasks give on the slots of a
    part in one row, and a part is counted where its rows were sent to."""
    def pack(slots: list[np.ndarray]) -> pa.RecordBatch:
        at = np.sort(np.concatenate(slots))
        parts, first = np.unique(at // PART, return_index=True)
        each = np.split((at % PART).astype(np.uint16), first[1:])
        return pa.RecordBatch.from_arrays([pa.array(parts.astype(np.int32)), pa.array([e.tobytes() for e in each], pa.binary())], ["part", "slots"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, size = [], 0
        for batch in batches:
            for x in batch.column(0):
                slots.append(_slots(prefix(np.frombuffer(x.as_buffer(), np.uint64), often, shingles)[0]))
                size += len(slots[-1])
                if size > 1 << 20:
                    yield pack(slots)
                    slots, size = [], 0
        if slots:
            yield pack(slots)

    def count(table: pa.Table) -> pa.Table:
        n = np.zeros(PART, np.int64)
        for x in table.column("slots"):
            n += np.bincount(np.frombuffer(x.as_buffer(), np.uint16), minlength=PART)
        return pa.table({"part": table.column("part")[:1], "bits": pa.array([np.packbits(n > 1).tobytes()], pa.binary())})

    found = texts.select("words").mapInArrow(run, "part int, slots binary").groupBy("part").applyInArrow(count, "part int, bits binary").toArrow()
    out = np.zeros((MARKS // PART, PART // 8), np.uint8)
    for part, bits in zip(*found.columns):
        out[part.as_py()] = np.frombuffer(bits.as_buffer(), np.uint8)
    return out.ravel()


def _slots(hashes: np.ndarray) -> np.ndarray:
    return ((hashes >> np.uint64(20)) % np.uint64(MARKS)).astype(np.int64)


def _by_prefix(members: DataFrame, words: DataFrame, shingles: float) -> DataFrame:
    """Members of small buckets as they are; the texts of large buckets under the shingles of their prefix,
    with the number `m` of their shingles and of those from that one on, `rest`."""
    sizes = keep(members.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > SMALL).select("bucket"))
    hot = keep(members.join(sizes, "bucket", "left_semi").select("id").distinct())
    texts = keep(words.join(hot, "id", "left_semi"))
    often = _histogram(texts)
    marks = _repeated(texts, often, shingles)

    def places(hashes: np.ndarray) -> np.ndarray:
        at = _slots(hashes)
        return np.flatnonzero(marks[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [prefix(np.frombuffer(x.as_buffer(), np.uint64), often, shingles) for x in batch.column(1)]
            if not found:
                continue
            at = [places(f) for f, _ in found]
            n = np.array([len(a) for a in at])
            m = np.repeat([m for _, m in found], n)
            rest = m - np.concatenate(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column(0).to_numpy(), n)), pa.array(np.concatenate([f[a] for (f, _), a in zip(found, at)]).astype(np.int64)),
                 pa.array(m.astype(np.int32)), pa.array(rest.astype(np.int32))], ["id", "bucket", "m", "rest"])

    dealt = texts.select("id", "words").mapInArrow(run, "id bigint, bucket bigint, m int, rest int")
    dealt = _shared(dealt.withColumn("bucket", F.xxhash64(F.lit("prefix"), "bucket")))
    return keep(members.join(sizes, "bucket", "left_anti").unionByName(dealt))


def _with_labels(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(id, bucket, label, n, main): the class of each member, and of each bucket the size and the
    most frequent class; only buckets that hold more than one class."""
    if labels is None:
        now = members.withColumn("label", F.col("id"))
    else:
        now = members.join(labels, "id", "left").select("id", "bucket", "m", "rest", F.coalesce("component", "id").alias("label"))
    now = keep(now)
    per_class = now.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    mixed = keep(per_class.groupBy("bucket").agg(
        F.sum("n").alias("n"), F.max_by("label", F.struct("n", F.negate("label"))).alias("main"),
        F.count("*").alias("classes")).filter("classes > 1").select("bucket", "n", "main"))
    return keep(now.join(mixed, "bucket"))


def _round_pairs(now: DataFrame, led: DataFrame | None, leaders: int, shingles: float, words: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(pairs a < b to compare, leaders): in small buckets all pairs of different classes; in large ones
    leaders with the members of other classes. Leaders are those members outside the bucket's main
    class with the smallest hash that did not lead there yet. When all of them led, every pair of
    classes of the bucket was compared. In buckets of the prefix filter a pair also needs as many shingles, from the
    shared one on, as the shingle similarity asks for; a pair meets under the first shingle it shares. In large buckets the parities
    of the two may differ in no more bits than the similarity allows them shingles that only one has."""
    def enough(m: str, rest: str) -> Column:
        need = shingles / (1 + shingles) * (F.col("m") + F.col(m))
        return (F.col("m") == 0) | (F.least("rest", rest) >= need - 1e-6)

    small = now.filter(F.col("n") <= SMALL)
    left = small.select("bucket", "m", "rest", F.col("id").alias("a"), F.col("label").alias("la"))
    right = small.select("bucket", F.col("m").alias("mb"), F.col("rest").alias("rb"), F.col("id").alias("b"), F.col("label").alias("lb"))
    pairs = left.join(right, "bucket").filter("a < b and la <> lb").filter(enough("mb", "rb")).select("a", "b")
    able = now.filter((F.col("n") > SMALL) & (F.col("label") != F.col("main"))).select("bucket", "id", "label", "m", "rest")
    if led is not None:
        able = able.join(led, ["bucket", "id"], "left_anti")
    order = Window.partitionBy("bucket").orderBy(F.xxhash64("id"), "id")
    chosen = able.withColumn("turn", F.row_number().over(order)).filter(F.col("turn") <= leaders)
    heads = keep(chosen.select("bucket", F.col("id").alias("head"), F.col("label").alias("head_label"), F.col("m").alias("mb"),
                               F.col("rest").alias("rb")))
    others, led_by, near = now.filter(F.col("n") > SMALL), heads, F.lit(True)
    if shingles > 0 and words is not None:
        others = others.join(words.select("id", "parity"), "id")
        led_by = heads.join(words.select(F.col("id").alias("head"), F.col("parity").alias("pb")), "head")
        differ = sum((F.bit_count(F.get("parity", F.lit(i)).bitwiseXOR(F.get("pb", F.lit(i)))) for i in range(PARITY)), F.lit(0))
        near = differ <= (1 - shingles) / (1 + shingles) * (F.col("m") + F.col("mb")) + 1e-6
    large = (others.join(led_by, "bucket").filter("label <> head_label").filter(enough("mb", "rb")).filter(near)
             .select(F.least("id", "head").alias("a"), F.greatest("id", "head").alias("b")))
    return pairs.unionByName(large).distinct(), heads.select("bucket", F.col("head").alias("id"))


def _refined(now: DataFrame, texts: DataFrame) -> DataFrame:
    """Large buckets of several classes are split by each further sketch; similar texts agree in about
    half of all sketches, so they meet again. Small buckets stay as they are."""
    large = now.filter(F.col("n") > SMALL).select("id", "bucket").join(texts, "id")
    split = large.select("id", "bucket", F.posexplode("keys").alias("number", "value")).select(
        "id", F.xxhash64("bucket", "number", "value").alias("bucket"))
    rows = now.filter(F.col("n") <= SMALL).select("id", "bucket").unionByName(split).distinct()
    return _shared(rows.withColumn("m", F.lit(0)).withColumn("rest", F.lit(0)))
