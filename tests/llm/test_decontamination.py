import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import decontamination as deco

BIG = 2**53 + 1
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, span=10):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(len(w), span)
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= {str(x) for x in windows[tuple(w[i : i + n])] if x is not None}
        out.append((doc_id, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(6)
    some = ["the", "of", "Ünder", "x1", "word", "日本", "and", "to", "a"]
    prose = lambda n, pool=some: " ".join(rng.choice(pool) + rng.choice(["", ",", ".\n", "-"]) for _ in range(n))
    items = [(i, prose(rng.randint(10, 40))) for i in range(30)]
    items += [(40, "short item here"), (41, "One"), (42, None), (43, ""), (44, "?!"), (None, prose(14)), (7, prose(15)), (45, items[3][1])]
    docs = [(i, prose(rng.randint(0, 300))) for i in range(60)]
    docs += [(100 + i, prose(30) + " " + t + " " + prose(9)) for i, (_, t) in enumerate(items[:30])]
    docs += [(200, " ".join(words(items[2][1])[:10])), (201, " ".join(words(items[2][1])[1:10])), (202, "a short, item; HERE: ok")]
    docs += [(203, None), (204, ""), (205, "..."), (BIG, "one"), (None, items[1][1]), (100, docs[60][1]), (206, "q" * 3000 + " " + items[4][1])]
    return docs, items


@pytest.mark.parametrize("span, gram", [(10, 6), (10, 1), (4, 6), (13, 5)])
def test_hits_equal_all_windows(spark, span, gram):
    docs, items = corpus()
    df = spark.createDataFrame([(*d, "s", 1) for d in docs], "doc_id long, text string, item string, n_hit int").repartition(3)
    it = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, span int")
    got = deco.contamination(df, it, span, gram).collect()
    assert sorted([(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got], key=str) == brute(docs, items, span)
    for r in got:
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_hit"]
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))


def test_words_do_not_run_across_texts_or_blocks(monkeypatch):
    monkeypatch.setattr(deco, "BLOCK", 32)
    monkeypatch.setattr(deco, "_powers", [])
    texts = ["Ab", "cd ef", "", "gh" * 40 + " ij", "x " * 50, "Ä-ö 9z"]
    data, offsets = deco._buffers(pa.array(["no", *texts, None])[1:])
    low, starts, ends, hashes = deco.words_in(data[offsets[0] : offsets[-1]], offsets - offsets[0])
    found = [low[a:b].tobytes().decode() for a, b in zip(starts, ends)]
    assert found == [w for t in texts for w in words(t)]
    by = {}
    for w, h in zip(found, hashes.tolist()):
        assert by.setdefault(w, h) == h
    assert len(set(by.values())) == len(by)


def test_every_span_keeps_a_fingerprint():
    rng = np.random.default_rng(2)
    hashes = rng.integers(0, 5, 3000).astype(np.uint64)  # many ties
    text = np.repeat(np.arange(30), 100)
    for span, gram in ((10, 6), (3, 6), (1, 1), (12, 2)):
        at, _ = deco.winnow(hashes, text, span, gram)
        k = min(span, gram)
        for i in range(len(hashes) - span + 1):
            if text[i] == text[i + span - 1]:
                assert ((at >= i) & (at + k <= i + span)).any()


def test_a_full_filter_only_lets_more_through(spark, monkeypatch):
    docs, items = corpus()
    monkeypatch.setattr(deco, "BLOOM_BITS", 32)
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = [(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in deco.contamination(df, it).collect()]
    assert sorted(got, key=str) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = corpus()
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert deco.contamination(df.limit(0), it).count() == 0
    got = deco.contamination(df, it.limit(0)).collect()
    assert len(got) == len(docs) and not any(r["n_hit"] or r["items"] or r["spans"] for r in got)
