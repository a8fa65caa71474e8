"""The prefix trie against nested dictionaries, in shards of any size; parentheses against a stack."""

import hashlib
import math
import zlib
from collections import defaultdict

import numpy as np
import pytest

from propensity.llm import prefix_trie as pt

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text, _ in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own[c].append(((turn is not None, turn or 0, tie), (role, text)))
    turns = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    paths = {}
    for c, t in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = turns.get(c - int(math.fmod(c, 100)), [])[:h] + t[h:]
    members = defaultdict(list)
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members[tuple(p[:d])].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(paths[c]) == len(p)).encode()).hexdigest())
                  for p, m in members.items())


def conversations(n, seed, spread=3):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        for turn in range(int(rng.integers(0, 8))):
            rows.append((c * 7 - 150, turn if rng.random() > 0.1 else None, ["user", "assistant", None][turn % 3],
                         [None, "", "hi", "é\U0001f600", "ab" * 40][int(rng.integers(0, spread))], "clash"))
    return rows


@pytest.mark.parametrize("size, parts", [(1 << 17, 1), (5, 3), (40, 8)])
def test_equals_brute_force(spark, size, parts):
    rows = conversations(160, 5) + [(None, 0, "user", "lost", "x")]
    rows += [(1000 + k, 0, "user", "copy", "x") for k in range(60)] + [(1000 + k, 1, "bot", "copy", "x") for k in range(60)]
    rows += [(5000, t, "user", f"turn {t % 4}", "x") for t in range(300)] + [(5001, t, "user", f"turn {t % 4}", "x") for t in range(299)]
    rows += [(7000, 1, "a", "x", "x")] * 3 + [(7000, 1, "ax", "", "x")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = sorted(map(tuple, pt.prefix_nodes(df, size).select(*COLUMNS).collect()), key=lambda r: r[:2])
    assert got == brute(rows)


def test_empty_and_one_turnless(spark):
    assert pt.prefix_nodes(spark.createDataFrame([], SCHEMA)).count() == 0
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 0)  # its own turn goes, its base is absent
    rows = [(c, 0, "user", "gone", "x")]
    assert [tuple(r) for r in pt.prefix_nodes(spark.createDataFrame(rows, SCHEMA)).select(*COLUMNS).collect()] == brute(rows)


@pytest.mark.parametrize("shape", ["deep", "wide", "random"])
def test_find_close(shape):
    rng = np.random.default_rng(1)
    bits, depth = [], 0
    for _ in range(3000):
        down = {"deep": len(bits) < 1500, "wide": depth < 2, "random": rng.random() < 0.55}[shape]
        if down or depth <= 1:
            bits.append(1)
            depth += 1
        else:
            bits.append(0)
            depth -= 1
    bits += [0] * depth
    stack, want = [], {}
    for i, b in enumerate(bits):
        if b:
            stack.append(i)
        else:
            want[stack.pop()] = i
    opens = np.flatnonzero(np.array(bits))
    # the first parenthesis closes last, as in a trie's root
    assert pt.Parentheses(np.array(bits)).find_close(opens).tolist() == [want[i] for i in opens]
