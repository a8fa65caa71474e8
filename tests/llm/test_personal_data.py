"""Base spans against plain expressions, the field against enumeration, and held-out sentences."""

import itertools
import re

import numpy as np
import pyarrow as pa
import pytest

from propensity.llm import personal_data as pd_
from propensity.llm.arrow_text import bytes_of


def plain(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        s = sum(sum(divmod(2 * x, 10)) if i % 2 else x for i, x in enumerate(d[::-1]))
        if 16 <= len(d) <= 19 and s % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                  if 8 <= sum(c.isdigit() for c in m.group()) <= 15]


TEXTS = [None, "", "é a.b+c@mail-1.example.com, x@y", "1.2.3.4 256.1.1.1 001.2.3.4.5 1.2.3.4.5.6.7.8", "4111 1111 1111 1111 4111-1111-1111-1112",
         "+1 (456) 555-2186 and +12 3 +1234567", "١٢٣ +1٤٥٦٧٨٩٠", "9" * 5000, "x" * 30000 + " 10.0.0.1", "4111111111111111é ü1.1.1.1",
         "a@b.c.d@e.f", "\n\n 4.4.4.4\n+44 20 7946 0958."]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "c") for i, t in enumerate(TEXTS)] + [(2, TEXTS[2], "c"), (None, TEXTS[3], "c")]
    train = [(100 + i, f"word und {i}.{i % 200}.7.{i % 90} more. call +1 ({i % 900 + 100}) 555-{i % 9000 + 1000} now\nplain words only here. "
              f"mail name.{i}@mail{i % 9}.example.com or 4111111111111111 thanks", "c") for i in range(150)]
    return spark.createDataFrame(rows + train, "doc_id bigint, text string, spans string").repartition(3)


def test_spans(docs):
    field = pd_.fit(docs)
    rows = pd_.find_personal_data(docs, field).collect()
    assert len(rows) == docs.count()
    texts = dict(enumerate(TEXTS))
    for r in rows:
        if r.doc_id is not None and r.doc_id < 100:
            want = plain(texts[r.doc_id] or "")
            assert [(s.kind, s.start, s.end) for s in r.base] == want
            every = {(s.kind, s.start, s.end) for s in r.spans}
            assert set(want) <= every
            for k, a, b in every - set(want):
                assert not any(a < e and b > s for _, s, e in want) and 0 <= a < b <= len(texts[r.doc_id])
    nothing = pd_.find_personal_data(docs, None).collect()
    assert all(r.base == r.spans for r in nothing)
    assert pd_.fit(docs.limit(0)) is None and pd_.find_personal_data(docs.limit(0), field).count() == 0


def test_held_out_words(docs):
    field = pd_.fit(docs)
    text = "word und 9.88.7.6 more. call +1 (321) 555-9876 now\nmail other.77@mail3.example.com or 4111111111111111 thanks"
    data, offsets = bytes_of(pa.array([text]))
    s = pd_.sentences(data, offsets)
    want = pd_.tag_words(s, pd_.code_points(data), offsets, [plain(text)])
    assert field.decode(s).tolist() == want.tolist() and want.any()


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(1)
    k = len(pd_.TAGS)
    field = pd_.Field(rng.standard_normal((pd_.WIDTH, k)), rng.standard_normal((k, k)), rng.standard_normal(k))
    data, offsets = bytes_of(pa.array(["ab 12. c@d x\ny 3 +4", "", "one two three four", "z"]))
    s = pd_.sentences(data, offsets)
    tags, score = field.decode(s), field.scores(s.features)
    for a, b in zip(s.first[:-1], s.first[1:]):
        def value(path):
            return field.start[path[0]] + score[a, path[0]] + sum(
                field.transition[p, q] + score[a + t + 1, q] for t, (p, q) in enumerate(zip(path, path[1:])))
        assert value(tags[a:b]) == pytest.approx(max(map(value, itertools.product(range(k), repeat=b - a))))
    assert [data[x:y].tobytes() for x, y in zip(s.starts, s.ends)] == b"ab 12. c@d x y 3 +4 one two three four z".split()


def test_field_adds_cards_in_other_groupings(spark):
    def card(i):
        d = f"4{i * 7919 % 10 ** 14:014d}"
        return next(d + c for c in "0123456789" if pd_.luhn(d + c))

    def grouped(d, mark):
        return mark.join(d[k:k + 4] for k in range(0, 16, 4))

    train = [(i, f"in {1900 + i} we had {i} apples, host 10.{i}.7.{i % 90} said\nplease pay with {grouped(card(i), ['', ' ', '-'][i % 3])} before noon\n"
              f"call +1 ({i + 100}) 555-{i + 1000} or mail name.{i}@mail{i % 9}.example.com") for i in range(150)]
    field = pd_.fit(spark.createDataFrame(train, "doc_id bigint, text string"))
    marks = [".", "/", "_", "  "]
    tests = [(k, f"please pay with {grouped(card(1000 + k), m)} before noon") for k, m in enumerate(marks)]
    wrong = [(10 + k, t[:-13] + str((int(t[-13]) + 1) % 10) + t[-12:]) for k, t in tests]  # the last digit is another
    other = [(20, "please pay with 4111 1111 1111 1112 before noon"), (21, "order 12345678 of 2020 with 300.1.2.3 and 12 34 56")]
    rows = pd_.find_personal_data(spark.createDataFrame(tests + wrong + other, "doc_id bigint, text string"), field).collect()
    texts = dict(tests)
    assert all(not r.base for r in rows)
    for r in rows:
        cards = [(s.start, s.end) for s in r.spans if s.kind == "card"]
        assert cards == ([(16, len(texts[r.doc_id]) - 12)] if r.doc_id in texts else []), r
    assert pd_.matches("in 1999, 12; 4111111111111112; 300.1.2.3; 41111111111111111111")[1] == [("ip", 31, 40), ("card", 13, 29)]


def test_copies_do_not_fill_the_sample(spark):
    texts = [f"line {i} of {i * i} apples" for i in range(40)] + [f"mail a{i}@b{i}.example.com" for i in range(4)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    first = df.selectExpr("text", "xxhash64(text) AS h").filter("text LIKE 'line%'").orderBy("h").first().text
    hot = df.unionByName(spark.range(300).selectExpr(f"'{first}' AS text"))
    assert pd_.fit(hot, documents=44) is not None
    assert pd_.fit(hot, documents=1) is None
