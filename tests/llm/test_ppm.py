import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import ppm

WORDS = "the tion and re ondre heed. éa ß 日本 x".split()


def texts(n=60, seed=2):
    rng = random.Random(seed)
    return [" ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


class Brute:
    """The same model, byte by byte with sets."""

    def __init__(self, texts, order):
        self.order, self.counts = order, [defaultdict(Counter) for _ in range(order + 1)]
        grams = [Counter() for _ in range(order + 1)]
        for t in texts:
            s = b"\xff" * order + b" ".join(ppm.words_of(t)) + b"\xff"
            for i in range(order, len(s)):
                for j in range(order + 1):
                    grams[j][s[i - j : i + 1]] += 1
        for j, g in enumerate(grams):
            for k, n in g.items():
                self.counts[j][k[:-1]][k[-1]] = n

    def score(self, text):
        s = b"\xff" * self.order + b" ".join(ppm.words_of(text)) + b"\xff"
        total = 0.0
        for i in range(self.order, len(s)):
            excluded: set[int] = set()
            for j in range(self.order, -1, -1):
                seen = {k: n for k, n in self.counts[j].get(s[i - j : i], {}).items() if k not in excluded}
                if not seen:
                    continue
                mass = sum(seen.values())
                if s[i] in seen:
                    total += math.log10((seen[s[i]] - 0.5) / mass)
                    break
                total += math.log10(len(seen) / 2 / mass)
                excluded |= set(seen)
            else:
                total -= math.log10(256 - len(excluded))
        return total


@pytest.mark.parametrize("order,most", [(1, 1), (3, 10**6), (5, 10**6), (4, 150), (2, 1)])
def test_scores_equal_the_byte_by_byte_model(spark, order, most):
    rows = list(enumerate(texts())) + [(900, None), (901, ""), (902, "NEW wörds\x0b with\tsigns ☃"), (903, "the the"), (903, "the the")]
    df = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double")
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 7 == 2}
    training = [t for i, t in rows if i not in held]
    brute = Brute(training, order)
    counts = Counter(w for t in training for w in [*ppm.words_of(t), b"\xff"])
    n, v = sum(counts.values()), len(counts)
    got = ppm.score_held_out(df, order, most).toPandas()
    assert len(got) == len(rows) and set(got["train_tokens"]) == {n}
    by = dict(rows)
    for r in got.itertuples():
        tokens = [*ppm.words_of(by[r.doc_id]), b"\xff"]
        assert r.held_out == (r.doc_id in held)
        assert (r.n_tokens, r.n_known) == (len(tokens), sum(counts[t] > 0 for t in tokens))
        assert math.isclose(r.base_score, sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens), rel_tol=1e-9)
        assert math.isclose(r.score, brute.score(by[r.doc_id]), rel_tol=1e-9), r.doc_id


def test_parts_serve_every_context_once(spark):
    df = spark.createDataFrame(list(enumerate(texts())), "doc_id long, text string")
    trie = ppm.train(df, 4)["trie"]
    served = ppm.parts(trie, 150)
    assert len(served) > 3 and sorted(np.concatenate([e for _, e in served])) == list(range(1 << 16))
    assert sum(p.where("level >= 2").count() for p, _ in served) == trie.where("level >= 2").count()
    assert len(ppm.parts(trie)) == 1


def test_rare_words_are_joined(spark, monkeypatch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts(80, 5))], "doc_id long, text string")
    a = ppm.score_held_out(df, 2).toPandas().set_index("doc_id").sort_index()
    monkeypatch.setattr(ppm, "FREQUENT", 0.2)
    b = ppm.score_held_out(df, 2).toPandas().set_index("doc_id").sort_index()
    assert np.allclose(a["base_score"], b["base_score"]) and (a["n_known"] == b["n_known"]).all()


def test_longer_contexts_predict_held_out_text_better(spark):
    df = spark.createDataFrame(list(enumerate(texts(200, 7))), "doc_id long, text string")
    logs = [ppm.score_held_out(df, order).toPandas().query("held_out")["score"] for order in (1, 3)]
    assert len(logs[0]) > 15 and logs[1].sum() > 0.8 * logs[0].sum()  # logarithms are negative


def test_no_rows_and_no_training(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ppm.score_held_out(empty).count() == 0
    (row,) = ppm.score(spark.createDataFrame([(None, "ab")], "doc_id long, text string"), ppm.train(empty)).collect()
    assert row["doc_id"] is None and row["n_known"] == 0 and math.isclose(row["score"], -3 * math.log10(256))
