import random

import pytest

from tidemark.llm import tokens
from tidemark.llm.memo import PieceCounts, open_tokenizer

ODD = [
    None, "", " ", "   \n\n  ", "Hello, World!  it's   3pm.\n\nAnd we're off.", "a <|endoftext|> b<|endoftext|><|endof", "x" * 5000,
    "no-break\xa0space\x1cand\x85lines more　wide", "😀 日本語。 é́", "a\nb\n c \nd \n e", "he's he'Re 'll'", "\t\ttab\r\nnew",
]


@pytest.fixture(scope="module")
def library():
    return open_tokenizer(tokens.VOCABULARY)


def random_texts(n, longest, seed=8):
    rng = random.Random(seed)
    signs = ["a", "b", "Z", "1", "é", ".", "'s", "'", "*", " ", "  ", "\n", "\t", "<|endoftext|>", "<|", "the ", "'re", "\xa0", "tion, ", "😀"]
    return ["".join(rng.choice(signs) for _ in range(rng.randint(1, longest))) for _ in range(n)]


def test_pieces_give_the_counts_of_the_library(library):
    texts = [t or "" for t in ODD] + random_texts(1500, 40)
    texts += [t.replace("<|", "") for t in random_texts(1500, 40, 9)]
    for t, n in zip(texts, PieceCounts(library).count(texts)):
        assert n == len(library.encode(t, add_special_tokens=False).ids), t[:80]


def test_chunks_splice_to_the_count_of_the_whole(library):
    for t in random_texts(120, 900) + ["word " * 900, "x" * 3000, " " * 3000, "ab" * 50 + " " * 400 + "cd" * 700, "'" * 2000 + "re", "1 " * 3000]:
        want = len(library.encode(t, add_special_tokens=False).ids)
        for chunk, overlap in ((200, 60), (500, 150), (300, 299)):
            assert tokens.count_huge(library, t, chunk, overlap) == want, (chunk, overlap, t[:80])


def test_overlaps_are_widened_where_nothing_aligns(library, monkeypatch):
    seen = []
    real = tokens._starts
    monkeypatch.setattr(tokens, "_starts", lambda t, s: seen.append(len(s)) or real(t, s))
    text = "plain words here " * 30 + "y" * 700 + " plain words again" * 60
    assert tokens.count_huge(library, text, 400, 80) == len(library.encode(text, add_special_tokens=False).ids)
    assert len(set(seen)) > 2


def test_rows(spark, library):
    rows = [(i, t, 5, "keep") for i, t in enumerate(ODD)] + [(4, ODD[4], 5, "keep"), (99, "some words. " * 12000, 0, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, other string")
    got = tokens.count_tokens(df).toPandas()
    assert len(got) == len(rows) and set(got.columns) == {"doc_id", "text", "other", "n_bytes", "n_tokens", "over_limit"}
    for r in got.itertuples():
        t = r.text or ""
        assert (r.n_bytes, r.n_tokens) == (len(t.encode()), len(library.encode(t, add_special_tokens=False).ids))
        assert r.over_limit == (r.n_tokens > 512)
    assert tokens.count_tokens(df.limit(0)).count() == 0
