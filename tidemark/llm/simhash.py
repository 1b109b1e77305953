"""SimHash near-duplicates, compared by bit planes.

Fingerprints that differ in few bits agree on whole blocks of bits, so each fingerprint goes
to one bucket for every choice of blocks it may agree on. Inside buckets the bits are stored
vertically: one word of a plane has the same bit of 64 members. A query is compared with 64
members at once; differing bits are added up by carry-save counters that are bit planes
themselves, and blocks of members that have all gone beyond the radius are dropped.

Copies of a fingerprint are one member. Only links that join parts of a bucket leave a task,
so a group of near copies yields as many links as it has members, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, temporary
from tidemark.llm.components import components

SHINGLE = 4
RADIUS = 4
SEED = 42
#: blocks of a fingerprint; two within the radius agree on at least BLOCKS - radius of them
BLOCKS = 6
#: members of a bucket that one task compares; larger buckets are split into pairs of parts
BUCKET_ROWS = 32_768
#: comparisons of a query with a word of 64 members that are worked on at a time
SLAB = 1 << 15


# ---- fingerprints ------------------------------------------------------------------


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits, each the majority of that bit over the hashes of all shingles, repeats included.

    Words are runs of anything but ASCII white space, A-Z lower-cased. A text with fewer
    words than a shingle is one shingle; without words the fingerprint is zero.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: n - shingle + 1].tolist(), ends[shingle - 1 :].tolist()) if n >= shingle else [(0, len(joined))]
    hashes = np.array([digest(joined[a:b], seed) for a, b in spans], np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, carry: str | None = None) -> DataFrame:
    """``doc_id`` and ``bits``, the fingerprint as a signed long, of every row; ``carry`` names a long that goes along."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            bits = np.array([fingerprint(t, shingle) for t in b["text"]], np.uint64)
            out = pd.DataFrame({"doc_id": b["doc_id"], "bits": bits.view(np.int64)})
            yield out.assign(**{carry: b[carry]}) if carry else out

    # ids travel as text: in pandas numbers beside a null are floats
    more = [carry] if carry else []
    schema = "doc_id string, bits long" + "".join([f", `{c}` long" for c in more])
    prints = docs.select(F.col("doc_id").cast("long").cast("string"), "text", *more).mapInPandas(run, schema)
    return prints.withColumn("doc_id", F.col("doc_id").cast("long"))


# ---- comparison --------------------------------------------------------------------


def _beyond(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose counter is above the radius."""
    above, equal = over.copy(), ~over
    for j in reversed(range(len(counters))):
        if radius >> j & 1:
            equal &= counters[j]
        else:
            above |= equal & counters[j]
            equal &= ~counters[j]
    return above


def compare_buckets(bits: np.ndarray, sizes: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of row numbers within ``radius`` bits, bucket by bucket, each pair once.

    ``bits`` holds the members of all buckets one after another, ``sizes`` how many each has.
    """
    bits, sizes = bits.astype(np.uint64), sizes.astype(np.int64)
    words = -(-sizes // 64)
    first_row, first_word = np.cumsum(sizes) - sizes, np.cumsum(words) - words
    rank = np.arange(len(bits)) - np.repeat(first_row, sizes)
    word = np.repeat(first_word, sizes) + rank // 64
    starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])  # the first row of every word
    lane = (rank % 64).astype(np.uint64)
    one = np.uint64(1)
    planes = [np.add.reduceat((bits >> np.uint64(j) & one) << lane, starts) for j in range(64)]
    filled = np.add.reduceat(one << lane, starts)
    # A query meets the members after it: the rest of its own word and all later words of its bucket.
    left = np.repeat(first_word + words, sizes) - word
    bounds = np.cumsum(left)
    width = max(1, radius.bit_length())
    at = 0
    while at < len(bits):
        done = bounds[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(bounds, done + SLAB, "right")))
        many = left[at:to]
        q = np.repeat(np.arange(at, to), many)
        w = word[q] + np.arange(len(q)) - np.repeat(np.cumsum(many) - many, many)
        own = w == word[q]
        alive = filled[w]
        after = ~((one << lane[q[own]]) | ((one << lane[q[own]]) - one))
        alive[own] &= after
        query = bits[q]
        counters = [np.zeros(len(q), np.uint64) for _ in range(width)]
        over = np.zeros(len(q), np.uint64)
        for j in range(0, 64, 2):
            x, y = (planes[i][w] ^ (np.uint64(0) - (query >> np.uint64(i) & one)) for i in (j, j + 1))
            both = counters[0] ^ x
            carry = (counters[0] & x) | (both & y)
            counters[0] = both ^ y
            for i in range(1, width):
                counters[i], carry = counters[i] ^ carry, counters[i] & carry
            over |= carry
            if j % 8 == 6:
                alive &= ~_beyond(counters, over, radius)
                live = alive != 0
                if not live.any():
                    break
                if live.mean() < 0.7:
                    q, w, query, alive, over = q[live], w[live], query[live], alive[live], over[live]
                    counters = [c[live] for c in counters]
        live = np.flatnonzero(alive)
        if len(live):
            hit = np.unpackbits(alive[live].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            r, k = np.nonzero(hit)
            yield q[live][r], starts[w[live][r]] + k
        at = to


def _join(parent: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Join the trees of linked rows; a root is its tree's smallest row."""
    while len(u):
        a, b = parent[u], parent[v]
        apart = a != b
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := parent[parent], parent):
            parent[:] = up


def _bucket_links(radius: int):
    def links(key: np.ndarray, bits: np.ndarray, node: np.ndarray) -> pd.DataFrame:
        edges = np.flatnonzero(np.r_[True, key[1:] != key[:-1], True])
        sizes = np.diff(edges)
        several = np.repeat(sizes > 1, sizes)
        bits, node, sizes = bits[several], node[several], sizes[sizes > 1]
        parent = np.arange(len(bits))
        if len(bits):
            for u, v in compare_buckets(bits, sizes, radius):
                _join(parent, u, v)
        joined = parent != np.arange(len(bits))
        return pd.DataFrame({"a": node[joined], "b": node[parent[joined]]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # the last bucket may go on in the next batch
        for b in batches:
            last = b["bucket"].to_numpy()[-1]
            if held and held[0]["bucket"].to_numpy()[0] == last:
                held.append(b)
                continue
            new = b["bucket"].to_numpy() == last
            whole = pd.concat([*held, b[~new]])
            held = [b[new]]
            if len(whole):
                yield links(whole["bucket"].to_numpy(), whole["bits"].to_numpy().view(np.uint64), whole["node"].to_numpy())
        if held:
            whole = pd.concat(held)
            yield links(whole["bucket"].to_numpy(), whole["bits"].to_numpy().view(np.uint64), whole["node"].to_numpy())

    return run


def link(members: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links ``a``, ``b`` between ``node`` values that join all within ``radius`` bits.

    ``members`` has a row for each distinct ``bits`` (long) with its ``node`` (long). Not every
    pair is returned, but pairs within the radius are always connected by those that are.
    """
    agree = blocks - radius
    if agree < 1:
        raise ValueError("more blocks than the radius are needed")
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), agree):
        mask = 0
        for i in chosen:
            mask |= (1 << cuts[i + 1]) - (1 << cuts[i])
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("bits").bitwiseAND(F.lit(m).cast("long"))) for i, m in enumerate(masks)])
    keyed = members.select("bits", "node", F.explode(keys).alias("bucket"))

    crowded = materialise(
        keyed.groupBy("bucket").count().where(F.col("count") > bucket_rows), "crowded"
    ).select("bucket", F.ceil(F.col("count") / bucket_rows).cast("int").alias("parts"))
    if crowded.isEmpty():
        keyed = keyed.withColumn("pair", F.lit(0))
    else:
        # Parts are met in pairs: a row goes to every pair that its part belongs to.
        keyed = keyed.join(crowded, "bucket", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        own = F.pmod(F.hash("bits"), F.col("parts"))
        keyed = keyed.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        keyed = keyed.withColumn("pair", F.least("own", "other") * F.col("parts") + F.greatest("own", "other"))
        keyed = keyed.withColumn("bucket", F.when(F.col("parts") > 1, F.xxhash64("bucket", "pair")).otherwise(F.col("bucket")))
    dealt = keyed.select("bucket", "bits", "node").repartition("bucket").sortWithinPartitions("bucket", "bits")
    return dealt.mapInPandas(_bucket_links(radius), "a long, b long")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, blocks: int = BLOCKS, carry: str | None = None
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of every row.

    Two documents are linked if their fingerprints differ in at most ``radius`` bits;
    ``component_id`` is the smallest ``doc_id`` that links reach, the document's own included.
    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored, but for a column of longs without
    nulls that ``carry`` may name.

    A null or empty text has the fingerprint zero and links like any other. A row without a
    ``doc_id`` links with nothing and its ``component_id`` is null. Repeated rows repeat.
    """
    prints = materialise(fingerprints(docs, shingle, carry), "fingerprints")
    members = materialise(
        prints.where("doc_id IS NOT NULL").groupBy("bits").agg(F.min("doc_id").alias("node")), "fingerprint-members"
    )
    found = materialise(components(link(members, radius, blocks)), "components")
    ids = members.join(found, "node", "left").select("bits", F.coalesce("component", "node").alias("component_id"))
    joined = prints.join(ids, "bits", "left")
    return joined.select(
        "doc_id",
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
        *([carry] if carry else []),
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id; columns as they came.

    Repeated rows of a document count as one; different texts under one id are documents of their own.
    Rows without a ``doc_id`` all stay.
    """
    (which,) = temporary("which")
    marked = docs.withColumn(which, F.xxhash64("text"))
    chosen = near_duplicates(marked, shingle, radius, carry=which).where("doc_id = component_id").select("doc_id", which).distinct()
    kept = marked.join(chosen, ["doc_id", which], "left_semi").dropDuplicates(["doc_id", which])
    return kept.unionByName(marked.where("doc_id IS NULL")).select(*[f"`{c}`" for c in docs.columns])
