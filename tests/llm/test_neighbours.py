import numpy as np
import pytest

from tidemark.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, n string, key int"


def brute(ids, vectors, cosine=0.9):
    x = np.array(vectors, np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    close = x @ x.T >= cosine
    np.fill_diagonal(close, False)
    label = np.array(ids)
    while True:
        new = np.minimum(label, np.where(close, label[None, :], 2**62).min(axis=1))
        if (new == label).all():
            return dict(zip(ids, close.sum(axis=1))), dict(zip(ids, label)), int(close.sum()) // 2
        label = new


def cluster_data(n=600, dims=16, seed=3):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 6, dims))
    x = base[rng.integers(0, len(base), n)] + 0.07 * rng.normal(size=(n, dims))
    x[n // 2 : n // 2 + n // 4] = base[0] + 0.05 * rng.normal(size=(n // 4, dims))  # a crowd of near copies
    x[-60:] = x[0]  # and one of equal vectors
    return x.astype(np.float32)


@pytest.mark.parametrize("list_rows", [37, 4096])
def test_links_and_components(spark, list_rows):
    x = cluster_data()
    ids = list(range(1000, 1000 + len(x)))
    df = spark.createDataFrame([(i, [float(v) for v in r], "q", 1) for i, r in zip(ids, x)], SCHEMA).repartition(3)
    links, label, total = brute(ids, x)
    got = neighbours.near_vectors(df, list_rows=list_rows).toPandas().set_index("vec_id")
    assert got["n_links"].sum() >= 0.98 * 2 * total
    assert all(got["n_links"][i] <= links[i] for i in ids)
    same = np.mean([got["component_id"][i] == label[i] for i in ids])
    assert same > 0.98 and (got["kept"] == (got.index == got["component_id"])).all()


def test_pairs_are_counted_once_and_splitting_changes_nothing(spark):
    x = cluster_data(300, 8, 9)
    df = spark.createDataFrame([(i, [float(v) for v in r], "", 0) for i, r in enumerate(x)], SCHEMA)
    a, b = (neighbours.near_vectors(df, list_rows=r).toPandas().set_index("vec_id").sort_index() for r in (11, 10_000))
    assert a.equals(b)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [1.0, nan]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, []),
        (9, [1.0, 0.0]), (9, [1.0, 0.0]), (None, [1.0, 0.0]), (10, [1.0, 0.0, 0.0]), (11, [-1.0, -0.0]), (12, [-1.0, 0.0]),
    ]
    df = spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA)
    got = neighbours.near_vectors(df).collect()
    assert len(got) == len(rows)
    out = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got if r["vec_id"] is not None))
    assert out == [
        (1, 3, 1, True), (2, 3, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True),
        (9, 3, 1, False), (9, 3, 1, False), (10, 0, 10, True), (11, 1, 11, True), (12, 1, 11, False),
    ]
    (none,) = [r for r in got if r["vec_id"] is None]
    assert (none["n_links"], none["component_id"], none["kept"]) == (0, None, False)
    assert neighbours.near_vectors(df.limit(0)).count() == 0


def crowd(n, share, pair_cosine, dims=64, seed=5):
    """Random directions, and a crowd of different near copies that holds ``share`` of all rows."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    m = int(n * share)
    centre = rng.normal(size=dims)
    centre *= np.sqrt(pair_cosine / (1 - pair_cosine) * dims) / np.linalg.norm(centre)
    x[:m] += centre
    return rng.permutation(x)


@pytest.mark.parametrize("n, pair_cosine", [(3000, 0.92), (9000, 0.92), (9000, 0.88)])
def test_crowds_of_near_copies_keep_their_links(spark, n, pair_cosine):
    x = crowd(n, 1 / 3, pair_cosine).astype(np.float32)
    df = spark.createDataFrame([(i, r.tolist(), "", 0) for i, r in enumerate(x)], SCHEMA).repartition(3)
    unit = x.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    total = int((unit @ unit.T >= 0.9).sum()) - n
    got = neighbours.near_vectors(df).toPandas()
    assert 0.99 * total <= got["n_links"].sum() <= total
