import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import prefixes

BIG = 2**53 + 1
SCHEMA = "conv_id long, turn long, role string, text string"


def brute_nodes(convs):
    """Nodes of {conv_id: [(role, text)]} by plain dictionaries."""
    members, kids = defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                kids[tuple(turns[: d - 1])].add(tuple(turns[:d]))

    def below(p):
        saved = (len(members[p]) - 1) * len(p[-1][1].split()) if p else 0
        leaves = 0 if kids[p] else 1
        for k in list(kids[p]):
            more = below(k)
            saved, leaves = saved + more[0], leaves + more[1]
        return saved, leaves

    out = []
    for p, ms in members.items():
        saved, leaves = below(p)
        ends = ",".join(map(str, sorted(c for c in ms if len(convs[c]) == len(p))))
        parent = min(members[p[:-1]]) if p else None
        out.append((min(ms), len(p), parent, len(ms), len(kids[p]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own[c].append((role or "", text or ""))
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def random_rows(n, seed, words=4, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        if rng.random() < 0.1:
            continue
        for t in range(rng.randint(1, longest)):
            rows.append((c, t if t else None, rng.choice(["user", "assistant", None]), " ".join(rng.choice(["a b", "a", "", "c"]) for _ in range(rng.randint(0, words)))))
    return rows


def nodes(df, **more):
    got = prefixes.prefix_nodes(prefixes.with_shared_openings(prefixes.sequences(df)), **more)
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("shard_turns", [7, 10**6])
def test_nodes_equal_dictionaries(spark, shard_turns):
    rows = random_rows(150, 2, words=1, longest=5)
    # a group of copies, larger than a shard, beside longer ones that go on from them
    rows += [(1000 + 20 * i + j, t, "user", f"copy {t}") for i in range(12) for j in range(4) for t in range(3 + (j == 3))]
    rows += [(BIG, t, "user", f"long {t}") for t in range(60)]
    want = sorted(brute_nodes(rebuilt(rows)), key=lambda r: (r[0], r[1]))
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], SCHEMA + ", ids int, key string").repartition(5)
    got = nodes(df, shard_turns=shard_turns)
    assert got == sorted(want, key=lambda r: tuple(-1 if x is None else x for x in r)) or sorted(map(str, got)) == sorted(map(str, want))


def test_rows_are_sorted_with_what_they_share():
    rng = np.random.default_rng(5)
    seqs = [rng.integers(1, 3, rng.integers(0, 40)).tolist() for _ in range(400)] + [[1] * 37, [1] * 37, [1] * 32, []]
    conv = rng.permutation(len(seqs))
    lens = np.array([len(s) for s in seqs])
    order, shared = prefixes.sort_rows(np.array([x for s in seqs for x in s]), lens, conv)
    placed = [seqs[i] for i in order]
    assert [(seqs[i], conv[i]) for i in order] == sorted(zip(seqs, conv))
    for a, b, n in zip(placed, placed[1:], shared[1:]):
        assert n == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_turnless_null_and_repeated_rows(spark):
    # conversation 3 loses its only turn, as conversation 0 does not exist
    assert zlib.crc32(b"3") % 4 and 3 % 20
    df = spark.createDataFrame([(3, 1, "user", "gone")], SCHEMA)
    assert nodes(df) == [(3, 0, None, 1, 0, 1, 0, hashlib.sha256(b"3").hexdigest())]
    rows = [(40, None, None, None), (40, 1, "user", "x y"), (40, 1, "user", "x y"), (60, None, None, None)]
    got = nodes(spark.createDataFrame([*rows, (None, 1, "user", "nobody")], SCHEMA))
    assert sorted(map(str, got)) == sorted(map(str, brute_nodes(rebuilt(rows))))
    assert nodes(df.limit(0)) == []
