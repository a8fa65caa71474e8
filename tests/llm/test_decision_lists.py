"""Text statistics against plain Python, and learned lists on planted rules."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from propensity.llm import decision_lists as dl


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


TEXTS = [None, "", " \t\n\x0b\x0c\r ", "a", "a b", "a b c", "a b c a b c", "a a a a", "a a a a a", "x\ny\nx\nx \n \n \n", "a#b $5 <i>|",
         "été \U0001f600\U0001f600  x ", "a b c d a b c e a b", "one two\nthree one two\nthree", "w " * 3000 + "end"]


def test_statistics(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, "a b", "clash"), (3, "again", "clash")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_words string").repartition(3)
    got = sorted(dl.text_statistics(df).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect(), key=str)
    assert [tuple(r) for r in got] == sorted([(i, *plain(t)) for i, t, _ in rows], key=str)


def test_equal_hashes_are_told_apart(spark):
    """Windows that share a hash are compared as strings."""
    df = spark.createDataFrame([("a b c d e f a b c".split(), [7] * 7)], "w array<string>, h3 array<bigint>")
    assert dl.with_repeated_windows(df).first().places == [0, 6]


def stats_rows(spark, n=600):
    """Bad rows: symbols of 30 and more; or many marks in short words. A few labels are wrong."""
    df = spark.range(n).select(
        (F.col("id") % 7).cast("double").alias("word_length"), (F.col("id") % 61).cast("double").alias("symbols"),
        (F.col("id") % 11).cast("double").alias("marks"), (100 + F.col("id")).cast("double").alias("n_words"),
        *[F.lit(0.0).alias(c) for c in ("dup_lines", "repeated", "different", "line_words")])
    bad = (F.col("symbols") >= 30) | ((F.col("marks") >= 8) & (F.col("word_length") <= 2))
    return df.withColumn("bad", bad.cast("int")).withColumn("growing", F.pmod(F.xxhash64("n_words"), F.lit(3)) < 2)


def test_planted_rules_are_found(spark):
    rows = stats_rows(spark)
    rules = dl.learn(rows)
    assert rules and all(r.wrong == 0 for r in rules)
    assert str(rules[0]) == "symbols >= 30"
    judged = rows.withColumn("n_repeat_words", F.lit(0)).transform(lambda df: dl.judge(df, rules))
    assert judged.filter((F.col("bad") == 1) == F.col("kept")).count() == 0
    assert judged.filter("rule is not null and kept").count() == 0


def test_one_class_and_empty_give_no_rule(spark):
    rows = stats_rows(spark)
    assert dl.learn(rows.filter("bad = 0")) == []
    assert dl.learn(rows.limit(0)) == []


def test_pruning_drops_what_does_not_help(spark):
    rows = stats_rows(spark)
    grown = [dl.Condition("symbols", True, 30.0), dl.Condition("n_words", False, 300.0)]
    assert dl.pruned(rows, grown, 0.8).conditions == (grown[0],)
    assert dl.pruned(rows, [dl.Condition("n_words", True, 0.0)], 0.8) is None


def test_labels_that_contradict_are_left_out(spark):
    docs = spark.createDataFrame([(i, "w%d " % i * 2 + " ".join(f"a{i}x{k}" for k in range(60))) for i in range(4)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (2, None), (None, 0), (9, 0)], "doc_id bigint, quality int")
    assert [r.bad for r in dl.labelled(dl.text_statistics(docs), labels).collect()] == [0]


def test_query_equals_plain_python_and_labels(spark, small):
    out = entry_points.queries()["op11_quality_rules"](spark, small)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = {r.doc_id: r for r in out.collect()}
    assert set(got) == set(docs)
    for i, r in got.items():
        want = plain(docs[i])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    judged = [(got[i].kept, q) for i, q in labels.items() if i in got and not got[i].base_failed]
    assert sum(k == (q == 1) for k, q in judged) / len(judged) >= 0.9


@pytest.mark.parametrize("table", ["documents", "labels"])
def test_empty_tables(spark, table):
    docs = spark.createDataFrame([(1, "x y z")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 0)], "doc_id bigint, quality int")
    docs, labels = (docs.limit(0), labels) if table == "documents" else (docs, labels.limit(0))
    assert dl.filter_quality(docs, labels).count() == (table == "labels")
