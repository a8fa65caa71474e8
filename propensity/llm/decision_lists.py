"""Quality rules: text statistics as column expressions, and a learned decision list over them.

Everything that touches rows is a DataFrame expression. The list is learned by sequential covering:
a rule is grown condition by condition (largest information gain on the growing rows), its last
conditions are dropped while that helps on the pruning rows, the rows it covers go, and the next
rule starts. What the driver sees of a step are counts per (statistic, bin), whatever the table's size.

Defined cases. A null or empty text has no words and fails the base rules. A null doc_id is kept as a row;
it has no label. Labels that contradict each other for one doc_id, and null ones, are not learned from.
Without labels of both classes the list is empty and only the base rules decide. Repeated rows are
judged each by itself; copies fall on the same side of the growing and pruning split. Texts are whole: a row's words are one array, so
a text needs some ten times its size in memory while it is judged. Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.session import keep

# White space between words, symbols, and the base rules' limits.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOL = "[#*$%&|<>]"
LEAST_WORDS = 50
MOST_REPEATED = 50  # percent of the words

BINS = 32
MAX_CONDITIONS = 4
MAX_RULES = 16
PRECISION = 0.8  # of a rule, on pruning rows and on all rows it is learned from

# Statistics that rules may use: parts are per 100 words or lines; word_length and line_words are means.
STATISTICS = ("n_words", "word_length", "symbols", "dup_lines", "repeated", "marks", "different", "line_words")


@dataclass(frozen=True)
class Condition:
    """`column` at least (or at most) a value."""
    column: str
    at_least: bool
    value: float

    def expr(self) -> Column:
        return F.col(self.column) >= self.value if self.at_least else F.col(self.column) <= self.value

    def __str__(self) -> str:
        return f"{self.column} {'>=' if self.at_least else '<='} {self.value:.6g}"


@dataclass(frozen=True)
class Rule:
    """Rows that meet all conditions are rejected; counts are those of the rows it was learned from."""
    conditions: tuple[Condition, ...]
    caught: int
    wrong: int

    def expr(self) -> Column:
        return all_of(self.conditions)

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def all_of(conditions: tuple[Condition, ...] | list[Condition]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c.expr()
    return out


def occurrences(text: Column, one: str) -> Column:
    """How many characters of a class the text holds."""
    return (F.length(text) - F.length(F.regexp_replace(text, one, ""))).cast("bigint")


def window_hashes(hashes: str) -> Column:
    """A hash of every 3 neighbours of an array column."""
    n = F.size(hashes) - 2
    return F.when(n > 0, F.transform(F.arrays_zip(F.slice(hashes, 1, n), F.slice(hashes, 2, n), F.slice(hashes, 3, n)),
                                     lambda x: F.xxhash64(x))).otherwise(F.array().cast("array<bigint>"))


def like_a_neighbour(rows: str, fields: tuple[str, ...]) -> Column:
    """Elements of a sorted array column that agree with the one before or after them.

    Takes a column name: an expression would be evaluated again for every element.
    """
    last = F.size(rows)

    def same(x: Column, y: Column) -> Column:
        out = F.lit(True)
        for f in fields:
            out = out & (x[f] == y[f])
        return out

    return F.filter(rows, lambda x, k: ((k > 0) & same(x, F.get(rows, k - 1))) | ((k < last - 1) & same(x, F.get(rows, k + 1))))


def with_repeated_windows(rows: DataFrame) -> DataFrame:
    """Replace h3 by `places`: sorted places of the 3-word windows that the text holds twice or more.

    Equal windows have equal hashes: those that share a hash are sorted as strings, so equal ones are neighbours.
    """
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    pairs = F.sort_array(F.arrays_zip(F.col("h3").alias("h"), F.sequence(F.lit(0), F.size("h3") - 1).alias("i")))
    rows = rows.withColumn("pairs", F.when(F.size(F.array_distinct("h3")) < F.size("h3"), pairs).otherwise(none)).drop("h3")
    rows = rows.withColumn("shared", like_a_neighbour("pairs", ("h",))["i"]).drop("pairs")
    rows = rows.withColumn("texts", F.sort_array(F.transform("shared", lambda i: F.struct(
        F.get("w", i).alias("a"), F.get("w", i + 1).alias("b"), F.get("w", i + 2).alias("c"), i.alias("i"))))).drop("shared")
    return rows.withColumn("places", F.sort_array(like_a_neighbour("texts", ("a", "b", "c"))["i"])).drop("texts")


def union_of_threes(places: Column) -> Column:
    """Size of the union of [p, p + 3) over sorted places p."""
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(places, start, lambda acc, p: F.struct(
        p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")), lambda acc: acc["n"])


def text_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, and STATISTICS.

    Steps are projections over arrays of one row: no shuffle, no explode.
    """
    t = F.col("t")
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = rows.select("id", "t", F.array_remove(F.split(t, SPACE), "").alias("w"), F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)).alias("l"))
    rows = rows.select("*", F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    rows = rows.select("*", window_hashes("h").alias("h3"))
    rows = with_repeated_windows(rows)
    rows = rows.select(
        "id", F.size("w").cast("bigint").alias("n_words"), F.size(F.array_distinct("h")).alias("n_different"),
        F.size("l").alias("n_lines"), (F.size("l") - F.size(F.array_distinct("l"))).cast("bigint").alias("n_dup_lines"),
        F.length(F.array_join("w", "")).cast("bigint").alias("word_chars"), union_of_threes(F.col("places")).alias("n_repeat_words"),
        occurrences(t, SYMBOL).alias("n_symbols"), occurrences(t, "[!?]").alias("n_marks"))
    part = lambda a, b: F.coalesce(F.try_divide(100.0 * F.col(a), F.col(b)), F.lit(0.0))
    return rows.select(
        F.col("id").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (part("word_chars", "n_words") / 100).alias("word_length"), part("n_symbols", "n_words").alias("symbols"),
        part("n_dup_lines", "n_lines").alias("dup_lines"), part("n_repeat_words", "n_words").alias("repeated"),
        part("n_marks", "n_words").alias("marks"), part("n_different", "n_words").alias("different"),
        (part("n_words", "n_lines") / 100).alias("line_words"))


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * n)


def labelled(stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """Statistics of the rows with one known label that pass the base rules: bad (1 or 0) and growing.

    Rows with equal statistics fall on the same side.
    """
    one = labels.groupBy(key).agg(F.min(label).alias("bad"), F.max(label).alias("other")).filter(
        F.col("bad").isin(0, 1) & (F.col("bad") == F.col("other")))
    side = F.pmod(F.xxhash64(*STATISTICS), F.lit(3)) < 2
    rows = stats.filter(~base_failed()).join(one.select(key, (1 - F.col("bad")).cast("int").alias("bad")), key)
    return rows.select("bad", side.alias("growing"), *[F.col(c).cast("double").alias(c) for c in STATISTICS])


def cut_points(rows: DataFrame, bins: int = BINS) -> dict[str, list[float]]:
    """Per statistic the values between which rows are counted: quantiles of each class, so a rare one has its own."""
    shares = [i / bins for i in range(bins + 1)]
    each = rows.groupBy("bad").agg(*[F.percentile_approx(c, F.array(*map(F.lit, shares)), 10_000).alias(c) for c in STATISTICS])
    found: dict[str, set[float]] = {c: set() for c in STATISTICS}
    for r in each.collect():  # two rows
        for c in STATISTICS:
            found[c] |= set(r[c] or ())
    return {c: sorted(v) for c, v in found.items()}


def bin_counts(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[str, list[tuple[int, int, int]]]:
    """Per statistic (bin, bad, good); bin b holds values from cut b - 1 up to below cut b."""
    places = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), sum(
        ((F.col(c) >= v).cast("int") for v in cuts[c]), F.lit(0)).alias("b")) for c in STATISTICS]))
    got = rows.select("bad", places.alias("p")).groupBy("p.c", "p.b").agg(
        F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good")).collect()  # statistics x bins
    out: dict[str, list[tuple[int, int, int]]] = {c: [] for c in STATISTICS}
    for r in got:
        out[r.c].append((r.b, r.bad, r.good))
    return out


def gain(bad: int, good: int, bad0: int, good0: int) -> float:
    """Information gained on the bad rows by going from the counts before to the counts now."""
    if not bad:
        return 0.0
    return bad * (math.log2(bad / (bad + good)) - math.log2(bad0 / (bad0 + good0)))


def best_condition(counts: dict[str, list[tuple[int, int, int]]], cuts: dict[str, list[float]]) -> tuple[float, Condition | None, int, int]:
    """(gain, condition, bad, good left); the first best by statistic, side and value."""
    best: tuple[float, Condition | None, int, int] = (0.0, None, 0, 0)
    for c in STATISTICS:
        bins = sorted(counts[c])
        bad0, good0 = sum(b for _, b, _ in bins), sum(g for _, _, g in bins)
        if not bad0:
            continue
        for at_least in (True, False):
            for k, v in enumerate(cuts[c]):
                # at least cut k: bins above k; at most the cut below: bins up to k, whose largest value lies below cut k
                inside = [x for x in bins if x[0] > k] if at_least else [x for x in bins if x[0] <= k]
                bad, good = sum(x[1] for x in inside), sum(x[2] for x in inside)
                if bad + good == bad0 + good0 or not bad:
                    continue
                value = v if at_least else math.nextafter(v, -math.inf)
                got = gain(bad, good, bad0, good0)
                if got > best[0] + 1e-9:
                    best = got, Condition(c, at_least, value), bad, good
    return best


def learn(rows: DataFrame, max_rules: int = MAX_RULES, max_conditions: int = MAX_CONDITIONS,
          precision: float = PRECISION) -> list[Rule]:
    """Ordered rules for the bad rows of `labelled`."""
    rows, rules = keep(rows), []
    cuts = cut_points(rows)
    left = rows
    while len(rules) < max_rules:
        grown: list[Condition] = []
        part = left.filter("growing")
        while len(grown) < max_conditions:
            got, condition, bad, good = best_condition(bin_counts(part, cuts), cuts)
            if condition is None:
                break
            grown.append(condition)
            part = part.filter(condition.expr())
            if not good:
                break
        if not grown:
            break
        rule = pruned(left, grown, precision)
        if rule is None:
            break
        rules.append(rule)
        left = left.filter(~rule.expr())
    return rules


def pruned(left: DataFrame, grown: list[Condition], precision: float) -> Rule | None:
    """The prefix of the conditions that is best on the pruning rows; None if it is not precise enough.

    Without pruning rows that a prefix covers, the growing rows decide.
    """
    sides, prefixes = ("growing", "pruning"), range(1, len(grown) + 1)
    side = {"growing": F.col("growing"), "pruning": ~F.col("growing")}
    counts = left.agg(*[F.count_if(all_of(grown[:k]) & side[s] & (F.col("bad") == b)).alias(f"{s}{k}{b}")
                        for s in sides for k in prefixes for b in (0, 1)]).first()
    value = lambda s, k: (counts[f"{s}{k}1"], counts[f"{s}{k}0"])
    worth = lambda bad, good: (bad - good) / (bad + good) if bad + good else -1.0
    k = max(prefixes, key=lambda k: (worth(*value("pruning", k)), -k) if any(value("pruning", len(grown))) else k)
    bad, good = (a + b for a, b in zip(value("growing", k), value("pruning", k)))
    tested = value("pruning", k) if any(value("pruning", k)) else value("growing", k)
    if bad < precision * (bad + good) or tested[0] < precision * sum(tested):
        return None
    return Rule(tuple(grown[:k]), bad, good)


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add base_failed, rule (the first that fits, else null) and kept."""
    fits = F.lit(None).cast("string")
    for r in reversed(rules):
        fits = F.when(r.expr(), F.lit(str(r))).otherwise(fits)
    out = stats.withColumn("base_failed", base_failed()).withColumn("rule", F.when(~F.col("base_failed"), fits))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def filter_quality(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Statistics and verdict of every document; the list is learned from `labels` (key, quality)."""
    stats = keep(text_statistics(docs, key, text))
    return judge(stats, learn(labelled(stats, labels, key)))
