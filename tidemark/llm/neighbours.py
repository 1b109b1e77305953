"""Near-duplicates of embeddings by a pivot-permutation index.

A vector is described by the order of the reference points (pivots) nearest to it. The first
few are its prefix, and an inverted list for each pivot holds the vectors with it in their
prefix. Vectors that share a pivot are candidates and are verified by their cosine in
double precision. A pair is judged in one list only, that of the first pivot both share.

Pivots lie far apart, so a crowd of near copies has one, however many rows it holds. A prefix
ends two link angles beyond its nearest pivot: of two linked vectors each then has the other's
nearest pivot in reach, and a crowd is compared in full in the few lists that it is in.

Equal vectors are one entry with a count. A list longer than a task should hold is cut into
parts that meet in pairs. Links stay inside a task: each vector leaves with its number of
links and one link towards its component.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise
from tidemark.llm.components import components
from tidemark.llm.simhash import _join

COSINE = 0.9
#: pivots are this many times the root of the number of vectors, within bounds; they are the sample the index is fitted on
PIVOTS_PER_ROOT = 4
MIN_PIVOTS, MAX_PIVOTS = 64, 65_536
#: vectors looked at for each pivot wanted; of two with at least this cosine one becomes a pivot
SAMPLE_PER_PIVOT = 2
APART = 0.5
#: nearest pivots that describe a vector, at most
PREFIX = 12
#: entries of a list that one task compares
LIST_ROWS = 4096
#: comparisons that are worked on at a time
SLAB = 1 << 19


def _unit(vectors: pd.Series) -> np.ndarray:
    x = np.array(vectors.to_list(), np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spread(unit: np.ndarray, wanted: int, apart: float = APART) -> np.ndarray:
    """Of the rows in their order those that have a cosine below ``apart`` with all taken before, ``wanted`` at most."""
    taken = unit[:0]
    for at in range(0, len(unit), 1024):
        block = unit[at : at + 1024]
        block = block[(block @ taken.T < apart).all(axis=1)]
        close, free, own = block @ block.T >= apart, np.ones(len(block), bool), []
        for i in range(len(block)):
            if free[i]:
                own.append(i)
                free &= ~close[i]
        taken = np.concatenate([taken, block[own]])[:wanted]
        if len(taken) == wanted:
            break
    return taken


def prefixes(unit: np.ndarray, pivots: np.ndarray, length: int, cosine: float = -1.0) -> np.ndarray:
    """The numbers of the nearest pivots, nearest first; of equally near ones the lower first.

    Pivots further than the nearest by more than twice the angle of ``cosine`` are left out, as -1.
    """
    near = -(unit @ pivots.T)
    out = np.argsort(near, axis=1, kind="stable")[:, :length]
    angles = np.arccos(np.clip(-np.take_along_axis(near, out, axis=1), -1, 1))
    return np.where(angles <= angles[:, :1] + 2 * np.arccos(np.clip(cosine, -1, 1)) + 1e-6, out, -1)


def compare(pivot: int, unit: np.ndarray, prefix: np.ndarray, part: np.ndarray | None, cosine: float):
    """Row pairs of an inverted list that are linked and have ``pivot`` as the first they share.

    With ``part``, only pairs of different parts are compared.
    """
    names, place = np.unique(prefix, return_inverse=True)
    place = place.reshape(prefix.shape)
    own = int(np.searchsorted(names, pivot))
    below = np.zeros((len(unit), -(-own // 64)), np.uint64)  # the pivots of each row before this one
    rows, at = np.nonzero((prefix >= 0) & (prefix < pivot))
    at = place[rows, at]
    np.bitwise_or.at(below, (rows, at // 64), np.uint64(1) << (at % 64).astype(np.uint64))
    step = max(1, SLAB // len(unit))
    for at in range(0, len(unit), step):
        close = unit[at : at + step] @ unit.T >= cosine
        i, j = np.nonzero(close)
        i += at
        keep = i < j if part is None else (i < j) & (part[i] != part[j])
        i, j = i[keep], j[keep]
        for k in range(0, len(i), SLAB // 8):
            a, b = i[k : k + SLAB // 8], j[k : k + SLAB // 8]
            ok = ~(below[a] & below[b]).any(axis=1)
            yield a[ok], b[ok]


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, prefix: int = PREFIX, list_rows: int = LIST_ROWS
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row of ``vec_id`` and ``embedding``.

    Vectors are linked if their cosine is at least ``cosine``; links are searched in the lists
    of shared pivots, so some may be missed (see the measured recall), but none is false.
    ``component_id`` is the smallest ``vec_id`` reachable, itself included, and the vector of that
    id is ``kept``. Other columns are ignored.

    A vector that is null, zero, or has null or non-finite components links with nothing. Equal
    vectors are linked to each other and count each, also as repeated rows with one id. A row
    without a ``vec_id`` links with nothing, has no component and is not kept. Vectors of
    different lengths are never linked.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("v", F.when(sound, F.transform("v", lambda x: x / F.lit(1.0) + F.lit(0.0))))
    rows = materialise(rows.withColumn("key", F.when(sound, F.xxhash64("v"))), "vectors")

    unique = rows.where("key IS NOT NULL").groupBy("key", "v").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    unique = materialise(unique, "unique-vectors")
    count = unique.count()
    wanted = min(count, MAX_PIVOTS, max(MIN_PIVOTS, math.ceil(PIVOTS_PER_ROOT * math.sqrt(count))))
    # At most SAMPLE_PER_PIVOT * MAX_PIVOTS vectors.
    chosen = unique.select("key", "node", "v").orderBy("key", "node").limit(max(1, SAMPLE_PER_PIVOT * wanted)).collect()
    by_size: dict[int, list] = {}
    for r in chosen:
        by_size.setdefault(len(r["v"]), []).append(r["v"])
    sent = vectors.sparkSession.sparkContext.broadcast({n: spread(_unit(pd.Series(v)), wanted) for n, v in by_size.items()})

    def describe(batches):
        for b in batches:
            sizes = b["v"].map(len).to_numpy()
            for n in np.unique(sizes):
                part = b[sizes == n]
                pivots = sent.value.get(int(n))
                if pivots is None:  # no pivot of this length: the vectors of a rare length share one list
                    lists = np.zeros((len(part), 1), np.int64)
                else:
                    lists = prefixes(_unit(part["v"]), pivots, prefix, cosine)
                yield part[["node", "copies", "v"]].assign(size=int(n), prefix=list(lists))

    fields = "node long, copies long, v array<double>, size int, prefix array<long>"
    entries = materialise(unique.mapInPandas(describe, fields), "prefixes")
    listed = entries.select("*", F.explode("prefix").alias("pivot")).where("pivot >= 0")
    long_lists = materialise(listed.groupBy("size", "pivot").count().where(F.col("count") > list_rows), "long-lists")
    # At most PREFIX * MAX_PIVOTS rows; the join decides by their size whether to broadcast.
    parts = long_lists.select("size", "pivot", F.ceil(F.col("count") / list_rows).cast("int").alias("parts"))
    listed = listed.join(parts, ["size", "pivot"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    listed = listed.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    listed = listed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    listed = listed.withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other"))

    def judge(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
        out = {"node": [], "links": [], "to": []}
        if len(b) > 1:
            b = b.sort_values("node")
            pivot, low, high = key[1:]
            node, copies = b["node"].to_numpy(), b["copies"].to_numpy()
            part = b["part"].to_numpy() if low != high else None
            lists = np.array(b["prefix"].to_list(), np.int64)
            links, parent = np.zeros(len(b), np.int64), np.arange(len(b))
            for i, j in compare(pivot, _unit(b["v"]), lists, part, cosine):
                np.add.at(links, i, copies[j])
                np.add.at(links, j, copies[i])
                _join(parent, i, j)
            linked = links > 0
            out = {"node": node[linked], "links": links[linked], "to": node[parent[linked]]}
        return pd.DataFrame(out).astype("int64")

    found = listed.select("size", "pivot", "low", "high", "part", "node", "copies", "v", "prefix")
    found = found.groupBy("size", "pivot", "low", "high").applyInPandas(judge, "node long, links long, to long")
    found = materialise(found, "vector-links")
    joined = materialise(components(found.select(F.col("node").alias("a"), F.col("to").alias("b"))), "components")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = unique.join(links, "node", "left").join(joined, "node", "left").select(
        "key",
        F.col("v").alias("same"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"),
        F.coalesce("component", "node").alias("c"),
    )
    # Equal vectors meet their entry under its hash; the vector itself decides.
    full = rows.join(known, (rows["key"] == known["key"]) & (rows["v"] == known["same"]), "left")
    component = F.coalesce("c", "vec_id")
    return full.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
