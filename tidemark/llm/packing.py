"""Hierarchical packing into sequences of several lengths.

Documents become pieces no longer than the longest window. A piece is routed to the shortest
tier that holds it and opens a sequence there; the gap behind it is filled from shorter
tiers, largest fitting piece first, and closed by cutting a piece. So sequences are full and
need no padding; what is left at the end of a partition is laid out in powers of two. Finished
sequences are dealt to step groups of equal tokens, with the attention cost balanced.

Packing is local to a partition, in pools of bounded size: no id of a token is ever shuffled,
memory doesn't grow with the partition, and a lost task is repeated with the same result.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.memo import WordIds

VOCABULARY = "word_bpe_49k.json"
END = 2
#: lengths of sequences, powers of two
TIERS = (256, 512, 1024, 2048, 4096)
#: tokens that are packed together, and tokens of a step group
POOL = 1 << 21
STEP = 1 << 16
#: texts that are encoded at a time, in characters
CHARS = 1 << 22

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "tier int, step_group long"
)

_workers: dict[str, WordIds] = {}


def _encoder(vocabulary: str) -> WordIds:
    if vocabulary not in _workers:
        _workers[vocabulary] = WordIds(vocabulary)
    return _workers[vocabulary]


class Packer:
    """Takes documents one by one and gives finished sequences, lists of (piece, offset).

    A piece is (length, number, doc, start): the number breaks ties in order of arrival, and
    doc is whatever the caller gave.
    """

    def __init__(self, tiers: tuple[int, ...] = TIERS, pool: int = POOL):
        if any(t & (t - 1) for t in tiers) or sorted(tiers) != list(tiers):
            raise ValueError("tiers are ascending powers of two")
        self.tiers, self.pool = tiers, pool
        self.pieces: list[tuple] = []  # ascending by length
        self.held = self.number = 0

    def add(self, doc: object, length: int) -> Iterator[tuple[int, list[tuple[tuple, int]]]]:
        """Sequences that are ready, as (tier, pieces with their offsets)."""
        longest = self.tiers[-1]
        whole = length - length % longest
        for start in range(0, whole, longest):
            self.number += 1
            yield longest, [((longest, self.number, doc, start), 0)]
        if length > whole:
            self._put(length - whole, doc, whole)
        if self.held >= self.pool:
            yield from self._pack(last=False)

    def finish(self) -> Iterator[tuple[int, list[tuple[tuple, int]]]]:
        yield from self._pack(last=True)

    def _put(self, length: int, doc: object, start: int) -> None:
        self.number += 1
        self.held += length
        insort(self.pieces, (length, self.number, doc, start), key=lambda p: p[:2])

    def _take(self, at: int) -> tuple:
        piece = self.pieces.pop(at)
        self.held -= piece[0]
        return piece

    def _cut(self, at: int, length: int) -> tuple:
        """The first ``length`` tokens of a piece; the rest goes back."""
        size, number, doc, start = self._take(at)
        if size > length:
            self._put(size - length, doc, start + length)
        return length, number, doc, start

    def _pack(self, last: bool) -> Iterator[tuple[int, list[tuple[tuple, int]]]]:
        # Without an end in sight the shortest pieces are left to fill the gaps of what comes.
        rest = 0 if last else self.pool // 8
        while self.held > rest and self.pieces:
            tier = next(t for t in self.tiers if t >= self.pieces[-1][0])
            while tier > self.held and tier > 1:  # not enough left to fill it
                tier //= 2
            sequence, filled = [], 0
            while filled < tier:
                gap = tier - filled
                at = bisect_right(self.pieces, gap, key=lambda p: p[0]) - 1
                # The largest that fits, if it is worth a place; else the gap is closed by a cut.
                fits = at >= 0 and (self.pieces[at][0] * 2 > gap or at + 1 == len(self.pieces))
                piece = self._take(at) if fits else self._cut(min(at + 1, len(self.pieces) - 1), gap)
                sequence.append((piece, filled))
                filled += piece[0]
            yield tier, sequence


def _step_groups(sequences: list[tuple[int, list]], step: int) -> list[int]:
    """A group for each sequence: equal tokens first, then the attention cost of their pieces."""
    groups = max(1, round(sum(t for t, _ in sequences) / step))
    loads = [(0, 0, g) for g in range(groups)]
    out = [0] * len(sequences)
    cost = [sum(p[0] ** 2 for p, _ in s) for _, s in sequences]
    for i in sorted(range(len(sequences)), key=lambda i: (-sequences[i][0], -cost[i])):
        tokens, work, g = heapq.heappop(loads)
        out[i] = g
        heapq.heappush(loads, (tokens + sequences[i][0], work + cost[i], g))
    return out


def pack(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    end: int = END,
    tiers: tuple[int, ...] = TIERS,
    pool: int = POOL,
    step: int = STEP,
) -> DataFrame:
    """A row for each piece of a document in a sequence.

    A document is its ids, without special tokens added, and ``end``. ``start`` and ``length``
    say which of its ``doc_tokens`` ids a piece holds, ``ids_crc32`` is the CRC-32 of these as
    little-endian 32-bit numbers, ``offset`` its place in ``sequence_id``. Offsets of a sequence
    have no gaps; its tokens are exactly ``tier``, a power of two up to the longest window.
    ``step_group`` names sequences of about ``step`` tokens to be trained on together.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A null or empty text is
    the ``end`` alone. A null ``doc_id`` stays null; repeated rows are packed each. An empty
    table gives no pieces. Ids of sequences and groups hold the number of their partition, and
    only tell them apart.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base = TaskContext.get().partitionId() << 32
        encoder, packer, closing = _encoder(vocabulary), Packer(tiers, pool), end.to_bytes(4, "little")
        counts = {"sequence": 0, "group": 0}

        def rows(done: list[tuple[int, list]]) -> pd.DataFrame:
            out = []
            groups = _step_groups(done, step)
            for (tier, sequence), group in zip(done, groups):
                for (length, _, (doc_id, ids), start), offset in sequence:
                    crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])
                    out.append((doc_id, start, length, crc, len(ids) // 4, base + counts["sequence"], offset, tier, base + counts["group"] + group))
                counts["sequence"] += 1
            counts["group"] += max(groups, default=-1) + 1
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")])
            return frame

        done: list[tuple[int, list]] = []
        for b in batches:
            ids, texts = b["doc_id"].to_list(), [t or "" for t in b["text"]]
            at = 0
            while at < len(texts):
                to, chars = at, 0
                while to < len(texts) and (to == at or chars + len(texts[to]) <= CHARS):
                    chars += len(texts[to])
                    to += 1
                for doc_id, encoded in zip(ids[at:to], encoder.encode(texts[at:to])):
                    encoded += closing
                    done.extend(packer.add((doc_id, encoded), len(encoded) // 4))
                at = to
            if sum(t for t, _ in done) >= pool:
                yield rows(done)
                done = []
        done.extend(packer.finish())
        if done:
            yield rows(done)

    # ids travel as text: in pandas numbers beside a null are floats
    packed = docs.select(F.col("doc_id").cast("long").cast("string"), "text").mapInPandas(run, SCHEMA.replace("doc_id long", "doc_id string"))
    return packed.withColumn("doc_id", F.col("doc_id").cast("long"))
