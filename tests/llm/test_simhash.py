import itertools

import numpy as np
import pandas as pd
import xxhash

from tidemark.llm import simhash
from tidemark.llm.components import components


def brute_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ")
    for c in "\t\n\r\f":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, radius=4):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, x), (b, y) in itertools.combinations(zip(ids, prints), 2):
        if bin(x ^ y).count("1") <= radius:
            r, s = sorted((root(a), root(b)))
            parent[s] = r
    return {i: root(i) for i in ids}


def test_fingerprint_is_the_majority_of_hashes():
    for text in (None, "", " \n\t ", "One", "a b c", "a b c d", "Ä b\x0bc D e f g A B", "x y " * 300 + "end"):
        assert simhash.fingerprint(text) == brute_print(text)


def test_compare_buckets_finds_every_pair_once():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    noisy = base[rng.integers(0, 40, 700)] ^ (np.uint64(1) << rng.integers(0, 64, 700, dtype=np.uint64))
    noisy ^= np.uint64(1) << rng.integers(0, 64, 700, dtype=np.uint64)
    sizes = np.array([1, 2, 64, 65, 130, 1, 437])
    got = [(int(a), int(b)) for u, v in simhash.compare_buckets(noisy, sizes) for a, b in zip(u, v)]
    want, at = set(), 0
    for s in sizes:
        for a, b in itertools.combinations(range(at, at + s), 2):
            if bin(int(noisy[a] ^ noisy[b])).count("1") <= 4:
                want.add((a, b))
        at += s
    assert len(got) == len(set(got)) and set(got) == want
    for radius in (0, 1, 3, 7):
        got = {(int(a), int(b)) for u, v in simhash.compare_buckets(noisy[:65], np.array([65]), radius) for a, b in zip(u, v)}
        want = {p for p in itertools.combinations(range(65), 2) if bin(int(noisy[p[0]] ^ noisy[p[1]])).count("1") <= radius}
        assert got == want


def test_components_are_stars_around_the_smallest(spark):
    path = [(i, i + 1) for i in range(1, 40)] + [(100, 50), (100, 60), (7, 7), (None, 3), (200, 201), (201, 200)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 50, 50: 50, 60: 50, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def texts():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choice(words, 220)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(60):
        w = base[i % 12].split()
        w[int(rng.integers(0, len(w)))] = "other"
        rows.append((100 + i, " ".join(w)))
    return rows + [(500, None), (501, ""), (502, "  "), (503, "Two words"), (504, "two  WORDS"), (505, "x " * 3000)]


def test_near_duplicates_equal_brute_force(spark):
    rows = texts()
    rows += [rows[0], rows[0]]  # repeated rows
    df = spark.createDataFrame([(i, t, 1, "q") for i, t in rows], "doc_id long, text string, bits int, node string")
    got = simhash.near_duplicates(df).toPandas()
    ids = [i for i, _ in dict(rows).items()]
    prints = [brute_print(t) for t in dict(rows).values()]
    want = brute_components(ids, prints)
    assert len(got) == len(rows)
    assert dict(zip(got["doc_id"], got["fingerprint"])) == {i: f"{p:016x}" for i, p in zip(ids, prints)}
    assert dict(zip(got["doc_id"], got["component_id"])) == want
    assert len(set(want.values())) < len(ids) - 20  # the copies do link
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))


def test_crowded_buckets_are_split_without_loss(spark):
    rows = texts()
    prints = {brute_print(t): i for i, t in reversed(rows)}
    signed = [(p - (1 << 64) if p >> 63 else p, i) for p, i in prints.items()]
    members = spark.createDataFrame(signed, "bits long, node long")
    want = brute_components(list(prints.values()), list(prints))
    for limit in (5, 10**6):
        got = {r["node"]: r["component"] for r in components(simhash.link(members, bucket_rows=limit)).collect()}
        assert {i: got.get(i, i) for i in want} == want


def test_empty_table_and_missing_ids(spark):
    schema = "doc_id long, text string"
    assert simhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    df = spark.createDataFrame([(None, "a b c d e"), (None, None), (3, "a b c d e")], schema)
    got = simhash.near_duplicates(df).toPandas()
    assert got["component_id"].isna().sum() == 2 and len(got) == 3
    assert simhash.keep_one(df).count() == 3
    assert isinstance(got, pd.DataFrame)
