"""The trie of conversation prefixes, from sorted matrices of turn ids.

A conversation is a row of turn ids (digests of role and text), padded to the width of the
widest. Sorted rows have the members of every node next to each other: where a row differs from
the one before in a column or any column left of it, a node of that depth starts. So all
figures of all nodes of a depth are sums and minima over stretches of rows.

Rows are dealt to shards by range, ties by conversation id, so no prefix or group of copies is
too common for a shard. A node may go on beyond its shard only along the ids that the
last row of one shard and the first of the next have in common; these few are put together from
parts, everything else is final where it is made. Figures of subtrees are written as sums over rows
to allow it: a row adds a leaf if no later row goes on where it ends, and the words from
the first turn it does not share with the row before are met for the first time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, words_of

#: turns of a shard, about, and columns of the matrix that are sorted at a time
SHARD_TURNS = 1 << 19
COLUMNS = 16


# ---- sequences ---------------------------------------------------------------------


def sequences(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``ids`` (16 bytes for each turn) and ``words`` (their number) in order of turns.

    Null roles and texts are empty, null turns come first, and equal turns are in order of
    their ids. Rows without a ``conv_id`` belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    turn = F.struct(
        F.col("turn").isNotNull().alias("given"), F.col("turn"), digest.alias("id"), F.size(words_of(text)).alias("words")
    )
    turns = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long"), turn.alias("t"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return whole.select("conv_id", F.col("t.id").alias("ids"), F.col("t.words").alias("words"))


def with_shared_openings(convs: DataFrame, block: int = 20, choices: int = 4) -> DataFrame:
    """``convs`` (see ``sequences``) where the first turns come from the first conversation of a block of ids.

    Conversation c takes the first h turns of c - c % ``block`` (fewer if it has fewer, none if it
    does not exist) in place of its own first h, with h the CRC-32 of c as text modulo ``choices``.
    """
    first = convs.where(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("base"), F.slice("ids", 1, choices - 1).alias("base_ids"), F.slice("words", 1, choices - 1).alias("base_words")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % choices).cast("int")
    joined = convs.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % block).join(first, "base", "left")

    def rebuilt(own: str, kind: str):
        opening = F.coalesce(F.slice(f"base_{own}", F.lit(1), F.col("h")), F.array().cast(kind))
        return F.concat(opening, F.slice(own, F.col("h") + 1, F.greatest(F.size(own), F.lit(1)))).alias(own)

    return joined.select("conv_id", rebuilt("ids", "array<binary>"), rebuilt("words", "array<int>"))


# ---- one shard ---------------------------------------------------------------------


def _ranks(ids: np.ndarray) -> np.ndarray:
    """Numbers from 1 on in the order of 16-byte ids, given as two big-endian columns."""
    if not len(ids):
        return np.zeros(0, np.int64)
    order = np.lexsort((ids[:, 1], ids[:, 0]))
    new = np.r_[True, (ids[order][1:] != ids[order][:-1]).any(axis=1)]
    out = np.empty(len(ids), np.int64)
    out[order] = np.cumsum(new)
    return out


def sort_rows(ranks: np.ndarray, lens: np.ndarray, conv: np.ndarray, columns: int = COLUMNS) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows by turn ids and conversation, and how many ids each shares with the one before it.

    The matrix is padded with 0 and handled ``columns`` at a time, further columns only for rows
    that have them, so memory is that of the turns and not of the longest row.
    """
    first = np.cumsum(lens) - lens
    order = np.argsort(conv, kind="stable")
    group, shared = np.zeros(len(lens), np.int64), np.zeros(len(lens), np.int64)
    at = 0
    while len(on := np.flatnonzero(lens[order] >= at)):
        rows = order[on]
        column = np.arange(at, at + columns)
        real = column < lens[rows][:, None]
        cells = np.zeros(real.shape, np.int64)
        cells[real] = ranks[(first[rows][:, None] + column)[real]]
        by = np.lexsort((*cells.T[::-1], group[on]))
        order[on], cells, real = rows[by], cells[by], real[by]
        # a change in any column so far marks a node start
        changed = np.empty((len(on), columns + 1), bool)
        changed[0, 0], changed[1:, 0] = True, group[on][1:] != group[on][:-1]
        changed[0, 1:], changed[1:, 1:] = True, cells[1:] != cells[:-1]
        np.logical_or.accumulate(changed, axis=1, out=changed)
        shared[on] += (~changed[:, 1:] & real).sum(axis=1)
        group[on] = on[np.maximum.accumulate(np.where(changed[:, -1], np.arange(len(on)), 0))]
        at += columns
    return order, shared


def _path_keys(ids: np.ndarray, depth: int) -> list[bytes]:
    """A digest of the first d ids, for d up to ``depth``."""
    path, out = hashlib.sha256(), []
    for d in range(depth + 1):
        if d:
            path.update(ids[d - 1].tobytes())
        out.append(path.copy().digest())
    return out


NODES = (
    "depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, key binary, parent_key binary, shard int, ends binary"
)
_NODES = pa.schema(
    [(n, {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[t]) for n, t in (x.split() for x in NODES.split(", "))]
)


def shard_nodes(shard: int, conv: np.ndarray, ids: np.ndarray, words: np.ndarray, lens: np.ndarray, before: int, after: int) -> Iterator[pa.RecordBatch]:
    """The nodes of a shard, a batch for each depth.

    ``before`` and ``after`` say how many ids its first and last row share with the
    neighbouring shards, -1 where there is none. A node that goes on there has a ``key`` and holds
    its part only; ``ends`` then are the conversations that end in it.
    """
    n = len(conv)
    order, shared = sort_rows(_ranks(ids), lens, conv)
    first = (np.cumsum(lens) - lens)[order]
    conv, lens = conv[order], lens[order]
    sums = np.concatenate(([0], np.cumsum(words, dtype=np.int64)))
    total = sums[first + lens]
    shared[0] = before
    new_words = total - sums[first + np.maximum(shared, 0)]
    following = np.r_[shared[1:], after]
    leaf = (following < lens).astype(np.int64)
    head = _path_keys(ids[first[0] : first[0] + max(before, 0)], before) if before >= 0 else []
    tail = _path_keys(ids[first[-1] : first[-1] + max(after, 0)], after) if after >= 0 else []

    on, parents = np.arange(n), None
    for d in range(int(lens.max()) + 1):
        on = on[lens[on] >= d]
        own = shared[on] < d  # a node starts here
        at = np.flatnonzero(own | (np.arange(len(on)) == 0))
        start = on[at]
        begun = own[at]
        rest = total[on] - sums[first[on] + max(d - 1, 0)]
        fresh = new_words[on].copy()
        fresh[at[begun]] = rest[at[begun]]
        ending = lens[on] == d
        n_ends = np.add.reduceat(ending.astype(np.int64), at)
        smallest = np.minimum.reduceat(conv[on], at)
        split: dict[int, bytes] = {}
        if d < len(tail):
            split[len(at) - 1] = tail[d]
        if d < len(head):
            split[0] = head[d]
        digests, ends = [], []
        for i, (a, k) in enumerate(zip(start.tolist(), n_ends.tolist())):
            listed = ",".join(map(str, conv[a : a + k].tolist())).encode() if k else b""
            digests.append(None if i in split else hashlib.sha256(listed).hexdigest())
            ends.append(listed if i in split and k else None)
        up = np.zeros(len(at), np.int64)
        if parents is not None:
            up = np.searchsorted(parents[0], start, "right") - 1
        parent_keys = [parents[2].get(i) for i in up.tolist()] if parents is not None and parents[2] else [None] * len(at)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(at), d, np.int64)),
                pa.array(smallest),
                pa.nulls(len(at), pa.int64()) if parents is None else pa.array(parents[1][up], mask=np.array([k is not None for k in parent_keys])),
                pa.array(np.add.reduceat(np.ones(len(on), np.int64), at)),
                pa.array(np.add.reduceat(((lens[on] > d) & (shared[on] <= d)).astype(np.int64), at)),
                pa.array(np.add.reduceat(leaf[on], at)),
                pa.array(np.add.reduceat(rest, at) - np.add.reduceat(fresh, at)),
                pa.array(digests, pa.string()),
                pa.array([split.get(i) for i in range(len(at))], pa.binary()),
                pa.array(parent_keys, pa.binary()),
                pa.array(np.full(len(at), shard, np.int32)),
                pa.array(ends, pa.binary()),
            ],
            schema=_NODES,
        )
        parents = (start, smallest, split)


def _of_shard(t: pa.Table) -> pa.Table:
    t = t.combine_chunks()
    lists = t["ids"].combine_chunks()
    flat = lists.flatten()
    _, offsets, data = flat.buffers()
    offsets = np.frombuffer(offsets, np.int32)[flat.offset : flat.offset + len(flat) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if len(flat) else np.zeros(0, np.uint8)
    ids = raw.view(">u8").astype(np.uint64).reshape(-1, 2)
    lens = lists.value_lengths().to_numpy().astype(np.int64)
    words = t["words"].combine_chunks().flatten().to_numpy().astype(np.int64)
    conv, bounds = t["conv_id"].to_numpy(), (t["shard"][0].as_py(), t["before"][0].as_py(), t["after"][0].as_py())
    return pa.Table.from_batches(shard_nodes(bounds[0], conv, ids, words, lens, *bounds[1:]), _NODES)


# ---- all shards --------------------------------------------------------------------


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest for each key of all its parts, which come one after another in order."""
    key, digest = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], ["key", "ends_sha256"])

    for b in batches:
        for k, part in zip(b.column(0).to_pylist(), b.column(1)):
            if k != key:
                if key is not None:
                    yield row()
                key, digest = k, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(part.as_py())
    if key is not None:
        yield row()


def prefix_nodes(convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """A row for every node of the trie of ``convs`` (``conv_id``, ``ids``, ``words``; see ``sequences``).

    A node is a distinct sequence of first turns, its members the conversations that start with it.
    ``conv_id`` is the smallest member, ``parent_conv_id`` that of the parent (null for the
    root), ``n_leaves`` counts the childless nodes of its subtree and ``saved_tokens`` sums, over
    its subtree, the words of a node's last turn for each member but one. ``ends_sha256`` is the
    SHA-256 of the conversations that end in the node, ascending, with commas between.

    ``conv_id`` is expected once each. Without conversations there are no nodes, not even a root.
    A conversation travels as one row of 20 bytes a turn, so that many must fit a task.
    """
    spark = convs.sparkSession
    convs = materialise(convs.select("conv_id", "ids", "words"), "turn-ids")
    turns = convs.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0)).alias("n")).first()["n"]
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // shard_turns))
    dealt = materialise(convs.repartitionByRange(shards, "ids", "conv_id").withColumn("shard", F.spark_partition_id()), "sharded-turn-ids")

    # what neighbours share: two rows for each shard
    edges = dealt.groupBy("shard").agg(
        F.min_by("ids", F.struct("ids", "conv_id")).alias("first"), F.max_by("ids", F.struct("ids", "conv_id")).alias("last")
    )
    w = Window.orderBy("shard")
    edges = edges.withColumn("previous", F.lag("last").over(w))
    differs = F.array_position(F.zip_with("previous", "first", lambda x, y: x.eqNullSafe(y)), F.lit(False))
    common = F.when(F.col("previous").isNull(), -1).when(differs == 0, F.size("first")).otherwise(differs - 1)
    edges = edges.select("shard", common.cast("int").alias("before"))
    edges = edges.withColumn("after", F.coalesce(F.lead("before").over(w), F.lit(-1)))

    nodes = dealt.join(materialise(edges, "shard-edges"), "shard").groupBy("shard").applyInArrow(_of_shard, NODES)
    nodes = materialise(nodes, "shard-nodes")

    parts = nodes.where("key IS NOT NULL")
    ends = parts.where("ends IS NOT NULL").select("key", "shard", "ends").repartition("key").sortWithinPartitions("key", "shard")
    digests = ends.select("key", "ends").mapInArrow(_digests, "key binary, ends_sha256 string")
    split = parts.groupBy("key").agg(
        F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.first("parent_key").alias("parent_key"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    split = materialise(split.join(digests, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))), "split-nodes")

    columns = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    above = split.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    final = nodes.where("key IS NULL AND parent_key IS NULL").select(*columns)
    below = nodes.where("key IS NULL AND parent_key IS NOT NULL").drop("parent_conv_id").join(above, "parent_key").select(*columns)
    joined = split.join(above, "parent_key", "left").select(*columns)
    out = final.unionByName(below).unionByName(joined)
    # a root without any turn below it is a leaf itself
    return out.withColumn("n_leaves", F.when(F.col("depth") == 0, F.greatest("n_leaves", F.lit(1))).otherwise(F.col("n_leaves")))
