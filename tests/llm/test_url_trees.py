"""URL parts and rules against plain Python; the trees on held-out URLs with a planted signal."""

import random
import re

import pytest

from propensity.llm import url_trees as ut

URLS = ["https://www.Example.com/en/1?x=1#t", "http://example.com/en/2", "http://a.b.example.com/en/", "http://example.com/de/",
        "http://x.net/es/1", "http://x.net/fr/", "http://net/fr/", "http://xnet/fr/", "http://x.org/en/", "http://x.com", "http://x.com?y=/",
        "no scheme", "", None, "ftp://H.COM/a://b/c", "://x.com/", "http://é.COM/É", "http://x.net/ES/", "http://x.com/a\nb", "http://www.example.com/en/\n://z"]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    m = re.match(r"[^/?#]*", rest)
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in m.group())
    path = re.match(r"[^?#]*", rest[m.end():]).group()
    fits = [r for r in ut.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best and best.verdict


@pytest.fixture(scope="module")
def judged(spark):
    rows = [(i, u, "clash", 1.0) for i, u in enumerate(URLS + URLS)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, host string, depth double").repartition(3)
    return ut.judge(df, rounds=3).collect()


def test_parts_and_rules(judged):
    assert len(judged) == 2 * len(URLS)
    verdicts = {}
    for r in judged:
        host, path, rule, verdict = brute(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule), r.url
        assert r.verdict == (verdict or ("block" if r.p_block >= 0.5 else "allow"))
        assert verdicts.setdefault(r.url, r.verdict) == r.verdict and r.depth == 1.0


def test_empty_and_one_class(spark):
    empty = spark.createDataFrame([], "page_id bigint, url string")
    assert ut.judge(empty).count() == 0
    one = spark.createDataFrame([(1, "http://a.com/x"), (2, "http://b.org/y"), (3, None)], "page_id bigint, url string")
    assert {r.verdict for r in ut.judge(one).collect()} == {"allow"}


def test_held_out_accuracy(spark):
    rng = random.Random(2)
    rows = []
    for i in range(1200):
        bad = rng.random() < 0.5
        host = f"{'cheap-offers' if bad else 'news'}{rng.randint(10, 99) if bad else ''}.site.{rng.choice(['org', 'info'])}"
        path = "/" + "/".join(str(rng.randint(1, 9)) * rng.randint(1, 6) if bad else "page" for _ in range(rng.randint(1, 4)))
        rows.append((f"http://{host}{path}", int(bad), i))
    df = spark.createDataFrame(rows, "url string, label int, n int")
    full = ut.lexical(ut.with_parts(df))
    model = ut.fit(full.filter("n < 800"), "label", "url", rounds=5)
    held = model.score(full.filter("n >= 800")).collect()
    assert sum((r.p_block >= 0.5) == bool(r.label) for r in held) / len(held) > 0.95


def test_copies_do_not_fill_the_sample(spark):
    rows = [(f"http://h{i}.{'info' if i % 2 else 'org'}/p{i}", i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "url string, label int")
    hot = df.orderBy(ut.F.xxhash64("url")).first()
    copies = spark.range(300).selectExpr(f"'{hot.url}' AS url", f"{hot.label} AS label")
    full = ut.lexical(ut.with_parts(df.unionByName(copies)))
    model = ut.fit(full, "label", "url", sample=100, rounds=2)
    assert model.trees is not None and 0.2 < model.share < 0.8
