import random
from functools import lru_cache

from tidemark.llm import licences as L


def common(a, b):
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_alignment_is_ordered_and_matches_equal_words():
    rng = random.Random(3)
    for _ in range(300):
        template = [rng.choice("abcdefghijklmnop") for _ in range(rng.randint(1, 14))]
        text = list(template)
        for _ in range(rng.randint(0, 4)):
            text.insert(rng.randint(0, len(text)), rng.choice("abxyz"))
        pairs = L.patience(text, template)
        assert all(text[i] == template[j] for i, j in pairs)
        assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:]))
        assert len(pairs) <= common(text, template)
    words = L.words_of(L.TEMPLATES["mit"])
    assert len(L.patience(words, words)) == len(words)
    changed = ["new", *words[:30], "other", *words[31:]]
    assert len(L.patience(changed, words)) == len(words) - 1
    assert L.patience([], words) == L.patience(words, []) == []
    values = [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5]
    assert [values[i] for i in L._longest_rise(values)] == [1, 2, 3, 5]


@lru_cache
def filler(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(["the", "and", "of", "tion", "ondre", "this", "or", "to", "license", "in"]) for _ in range(n))


def documents():
    t = L.TEMPLATES
    mit = t["mit"].split()
    return [
        (1, f"{filler(1, 300)}\n{t['mit-line']}\n{filler(2, 200)}", {"mit-line": 1}),
        (2, f"{t['apache-2.0-line']} {filler(3, 50)} {t['apache-2.0-line']}", {"apache-2.0-line": 2}),
        (3, " ".join(mit[:20] + ["changed"] + mit[21:60] + mit[64:]), {"mit": 1}),
        (4, filler(4, 3000), {}),
        (5, t["bsd-2-clause"].upper().replace(" ", "\n "), {"bsd-2-clause": 1}),
        (6, " ".join(mit[: len(mit) // 2]), {}),
        (7, None, {}),
        (8, "", {}),
        (9, f"{filler(5, 60000)} {t['cc-by-nc-4.0-line']}", {"cc-by-nc-4.0-line": 1}),
        (10, t["apache-2.0"], {"apache-2.0": 1, "apache-2.0-line": 1}),
        (11, t["isc"] + "\n" + t["zlib"], {"isc": 1, "zlib": 1}),
    ]


def test_planted_notices_are_found(spark):
    rows = documents()
    df = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(1, rows[0][1], "x")], "doc_id long, text string, license string")
    got = L.scan_licenses(df).collect()
    assert sum(r["doc_id"] == 1 for r in got) == 2
    for i, text, want in rows:
        found = {r["license"]: r for r in got if r["doc_id"] == i}
        assert {k: r["occurrences"] for k, r in found.items()} == want, i
        words = L.words_of(text or "")
        for name, r in found.items():
            template = L.words_of(L.TEMPLATES[name])
            # against the best alignment of the whole document, words out of place and all
            assert 0.8 <= r["coverage"] <= common(words[-500:] if i == 9 else words, template) / len(template)
            assert r["n_aligned"] == round(r["coverage"] * len(template))
            assert words[r["start_word"]] in template and words[r["end_word"] - 1] in template
    assert L.scan_licenses(df.limit(0)).count() == L.scan_licenses(df, {}).count() == 0
    nobody = spark.createDataFrame([(None, rows[0][1])], "doc_id long, text string")
    assert [r["doc_id"] for r in L.scan_licenses(nobody).collect()] == [None]
