import numpy as np
import pytest

from tidemark.llm import mixing

SCHEMA = "doc_id long, text string, rate int, p_a string"


def corpus(n=400, seed=1):
    rng = np.random.default_rng(seed)
    rows, labels = [], []
    for i in range(n):
        domain = "abc"[int(rng.integers(0, 3))]
        words = rng.choice([f"common{k}" for k in range(30)], int(rng.integers(30, 90))).tolist()
        words += rng.choice([f"{domain}{x}" for x in ("ant", "bee", "cow", "doe")], 3).tolist()
        rows.append((i, " ".join(words), 7, "x"))
        labels.append((i, domain))
    return rows, labels


def test_posteriors_and_rates(spark):
    rows, labels = corpus()
    train, held = labels[:250], labels[250:]
    docs, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(train, "doc_id long, domain string")
    targets = {"a": 0.6, "b": 0.3, "c": 0.1}
    got = mixing.mix(docs, known, targets).toPandas().set_index("doc_id").sort_index()
    assert len(got) == len(rows) and "text" in got
    best = got[["p_a", "p_b", "p_c"]].astype(float).idxmax(axis=1).str[-1]
    assert np.mean([best[i] == d for i, d in held]) > 0.95
    p = got[["p_a", "p_b", "p_c"]].to_numpy(float)
    assert np.allclose(p.sum(axis=1), 1)
    n, rate = got["n_tokens"].to_numpy(), got["rate"].to_numpy()
    assert (n == [len(t.split()) for _, t, _, _ in rows]).all() and (rate >= 0).all()
    totals = (p * (n * rate)[:, None]).sum(axis=0)
    assert np.allclose(totals / n.sum(), [0.6, 0.3, 0.1], atol=1e-4)
    assert (np.abs(got["copies"] - rate) < 1).all()
    # against projected gradients written out, until they stand still
    p0, r, goal = p, np.ones(len(n)), np.array([0.6, 0.3, 0.1]) * n.sum()
    scale = np.linalg.inv((p0 * n[:, None]).T @ p0)
    for _ in range(500):
        r = np.maximum(0, r - p0 @ (scale @ ((p0 * (n * r)[:, None]).sum(axis=0) - goal)))
    assert np.allclose(r, rate, atol=1e-3)


def test_cap_and_anchor_keep_the_anchor_whole(spark):
    rows, labels = corpus(300, 2)
    docs, known = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, domain string")
    kept = mixing.keep_mixed(docs, known, {"a": 0.9, "b": 0.1, "c": 0.0}, "a", 0.05)
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    domain = dict(labels)
    share = {d: np.mean([i in ids for i in domain if domain[i] == d]) for d in "abc"}
    assert share["a"] == 1 and share["c"] < 0.05 and 0.01 < share["b"] < 0.5


def test_targets_out_of_reach_are_approached_in_tokens(spark):
    rows, labels = corpus(400, 4)
    few = {i for i, d in labels if d == "b"} - set([i for i, d in labels if d == "b"][:6])  # a domain with hardly any rows
    docs = spark.createDataFrame([r for r in rows if r[0] not in few], SCHEMA)
    known = spark.createDataFrame(labels, "doc_id long, domain string")
    goals = {"a": 0.9, "b": 0.1, "c": 0.0}
    got = mixing.mix(docs, known, goals, anchor="a", headroom=0.05, max_rate=1.0).toPandas()
    p, n, rate = got[["p_a", "p_b", "p_c"]].to_numpy(float), got["n_tokens"].to_numpy(float), got["rate"].to_numpy(float)
    weighted = p * n[:, None]
    goal = np.array(list(goals.values())) / 0.9 * weighted[:, 0].sum() * 1.05
    best, step = np.ones(len(n)), 1 / np.linalg.eigvalsh(weighted.T @ p)[-1]
    for _ in range(20_000):
        best = np.clip(best - step * (p @ (weighted.T @ best - goal)), 0, 1)
    far, least = (np.linalg.norm(weighted.T @ r - goal) for r in (rate, best))
    assert least > 1 and far <= 1.02 * least and rate.max() <= 1


def test_odd_rows(spark):
    docs = [(1, None, 1, ""), (2, "", 1, ""), (None, "aant words here", 1, ""), (3, "bbee " * 5000, 1, ""), (3, "bbee " * 5000, 1, "")]
    labels = [(1, None), (None, "a"), (2, "other"), (3, "b"), (3, "b")]
    df = spark.createDataFrame(docs, SCHEMA)
    known = spark.createDataFrame(labels, "doc_id long, domain string")
    got = mixing.mix(df, known, {"a": 1, "b": 1}).toPandas()
    assert len(got) == 5 and got["rate"].notna().all() and got["n_tokens"].tolist().count(5000) == 2
    assert got.groupby("n_tokens")["rate"].nunique().max() == 1 or got["doc_id"].isna().any()
    empty = mixing.mix(df.limit(0), known.limit(0), {"a": 1, "b": 1})
    assert empty.count() == 0
    assert mixing.mix(df, known.limit(0), {"only": 2}).count() == 5
    with pytest.raises(ValueError):
        mixing.mix(df, known, {})


@pytest.mark.parametrize("sf", ["sf0.1"])
def test_domains_of_documents_that_were_not_fitted(spark, sf):
    """Held-out accuracy on the whole given table, by domain."""
    folder = f"/root/testdata/{sf}"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = mixing.domains_of(spark.read.parquet(f"{folder}/labels.parquet")).where("domain IS NOT NULL")
    held = labels.where("pmod(xxhash64('test', doc_id), 4) = 0")
    got = mixing.mix(docs, labels.join(held, "doc_id", "left_anti"), {"clean": 0.85, "low": 0.12, "toxic": 0.03}, carry=["doc_id"])
    rows = got.join(held, "doc_id").toPandas()
    best = rows[["p_clean", "p_low", "p_toxic"]].astype(float).idxmax(axis=1).str[2:]
    right = (best == rows["domain"]).groupby(rows["domain"]).mean()
    print(right.to_dict(), (best == rows["domain"]).mean(), rows["domain"].value_counts().to_dict())
    assert (best == rows["domain"]).mean() > 0.92
    assert right["clean"] > 0.95 and right["low"] > 0.85 and right["toxic"] > 0.7
