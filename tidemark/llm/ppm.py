"""Language-model scores by prediction by partial matching.

The model is a trie of byte contexts. A byte is coded in the longest known context; a byte new
there costs an escape, estimated by half the number of different bytes seen in the context
(method D: each byte's count gives half an occurrence to the escape), and is coded in the next
shorter one with the bytes of the longer one excluded. The code
length of a document, as a base-10 logarithm, is its score.

Counting covers all training documents and is spread over tasks, which send their distinct
grams only. Every gram is kept, and the trie is as large as the corpus makes it. A trie of up to
``PART`` grams goes to all tasks at once. A larger one goes in parts by the last two bytes of the
context, which all shorter contexts share but the two shortest, that go with every part: the
documents are read once for each part, each byte is scored where its context is, and the sums
are added. Unigram figures of words are kept beside it; frequent words go to all tasks (there
are at most a set number), all others are looked up by a join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

#: bytes of the longest context, at most 6
ORDER = 4
#: grams that are sent to all tasks at once; contexts with the same last two bytes stay together, with order 4 at most 2^24 grams
PART = 1 << 21
#: a word is frequent if it is this share of all tokens; others are joined
FREQUENT = 1e-6
MODULUS, HELD_OUT = 7, 2
#: ends a text and stands before it; no UTF-8 has it
END = 0xFF
#: bytes that are worked on at a time, and distinct entries a task holds before it sends them on
BLOCK = 1 << 20
HELD = 1 << 20


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return (text or "").encode().lower().split()


def codes(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """For each byte and the end of each text: its context and itself as one number, and where texts start.

    Between texts stand ``order`` entries that mean nothing, marked by the largest number.
    """
    pad = bytes([END]) * order
    data = np.frombuffer(b"".join([pad + t + b"\xff" for t in texts]) + pad, np.uint8)
    sizes = np.array([len(t) + 1 + order for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    n = int(sizes.sum())
    out = np.zeros(n, np.uint64)
    for j in range(order + 1):
        out <<= np.uint64(8)
        out |= data[j : n + j]
    gaps = ((starts + sizes)[:, None] - np.arange(1, order + 1)).ravel()
    out[gaps] = np.uint64(2**64 - 1)
    return out, starts


def _blocks(texts: list[bytes]) -> Iterator[list[bytes]]:
    some, size = [], 0
    for t in texts:
        some.append(t)
        size += len(t)
        if size >= BLOCK:
            yield some
            some, size = [], 0
    if some:
        yield some


# ---- counting ----------------------------------------------------------------------


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts, first)


def _count_partition(order: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: Counter[bytes] = Counter()
        grams: list[tuple[np.ndarray, np.ndarray]] = []

        def sent(all_words: bool, all_grams: bool) -> Iterator[pd.DataFrame]:
            if words and (all_words or len(words) > HELD // 4):
                yield pd.DataFrame({"word": [*words.keys()], "gram": pd.array([None] * len(words), "Int64"), "n": [*words.values()]})
                words.clear()
            if grams and (all_grams or sum(len(k) for k, _ in grams) > HELD):
                merged = _merge(grams)
                grams[:] = [merged]
                if all_grams or len(merged[0]) > HELD // 2:
                    yield pd.DataFrame({"word": None, "gram": merged[0].astype(np.int64), "n": merged[1]})
                    grams.clear()

        for b in batches:
            texts = []
            for t in b["text"]:
                ws = words_of(t)
                words.update(ws)
                texts.append(b" ".join(ws))
            words[b"\xff"] += len(texts)  # the end, a token of its own
            for some in _blocks(texts):
                c, _ = codes(some, order)
                grams.append(np.unique(c[c != np.uint64(2**64 - 1)], return_counts=True))
                yield from sent(False, False)
        yield from sent(True, True)

    return run


def train(docs: DataFrame, order: int = ORDER) -> dict:
    """Count ``text`` of all rows: tables ``words`` (word, n) and ``trie`` (level, gram, n), and totals."""
    if not 1 <= order <= 6:
        raise ValueError("the longest context has one to six bytes")
    counted = materialise(docs.select("text").mapInPandas(_count_partition(order), "word binary, gram long, n long"), "counts")
    words = counted.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
    words = materialise(words, "words")
    totals = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("types")).first()
    grams = materialise(counted.where("gram IS NOT NULL").groupBy("gram").agg(F.sum("n").alias("n")), "grams")
    levels = [grams.select(F.lit(order).alias("level"), "gram", "n")]
    for level in range(order - 1, -1, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << 8 * (level + 1)) - 1)).alias("gram")
        grams = grams.groupBy(shorter).agg(F.sum("n").alias("n"))
        levels.append(grams.select(F.lit(level).alias("level"), "gram", "n"))
    return {"words": words, "trie": materialise(reduce(DataFrame.unionByName, levels), "trie"), "order": order, **totals.asDict()}


def parts(trie: DataFrame, most: int = PART) -> list[tuple[DataFrame, np.ndarray | None]]:
    """The trie in parts of about ``most`` grams, each with the ends of contexts (two bytes) it serves; None for all."""
    if trie.count() <= most:
        return [(trie, None)]
    end = F.shiftright("gram", 8).bitwiseAND(F.lit(0xFFFF))
    sizes = trie.where("level >= 2").groupBy(end.cast("int").alias("end")).count().orderBy("end").collect()  # 65,536 at most
    firsts, filled = [0], 0
    for r in sizes:
        if filled and filled + r["count"] > most:
            firsts.append(r["end"])
            filled = 0
        filled += r["count"]
    stretches = zip(firsts, [*firsts[1:], 1 << 16])
    return [(trie.where((F.col("level") < 2) | end.between(low, high - 1)), np.arange(low, high)) for low, high in stretches]


# ---- the trie as tables -------------------------------------------------------------


class Table:
    """From numbers to positions by open addressing, for many numbers at a time."""

    def __init__(self, keys: np.ndarray):
        size = 1 << max(4, int(len(keys) * 2 - 1).bit_length())
        self.shift, self.mask = np.uint64(64 - size.bit_length() + 1), size - 1
        self.keys, self.at = np.full(size, 2**64 - 1, np.uint64), np.full(size, -1, np.int32)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self.at[slot] < 0
            self.at[slot[free]] = left[free]  # of several the last stays
            won = self.at[slot] == left
            self.keys[slot[won]] = keys[left[won]]
            left, slot = left[~won], (slot[~won] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Positions, -1 for numbers that are not there."""
        slot = self._slot(keys)
        found = self.at[slot]
        open_ = np.flatnonzero((found >= 0) & (self.keys[slot] != keys))
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & self.mask
            at = self.at[slot]
            found[open_] = at
            on = (at >= 0) & (self.keys[slot] != keys[open_])
            open_, slot = open_[on], slot[on]
        return found


class Model:
    """Logarithms for every gram and context of the trie."""

    def __init__(self, order: int, level: np.ndarray, gram: np.ndarray, n: np.ndarray):
        self.order = order
        self.levels = []
        below = None
        for j in range(order + 1):
            at = level == j
            keys, counts = gram[at].astype(np.uint64), n[at].astype(np.float64)
            sort = np.argsort(keys)
            keys, counts = keys[sort], counts[sort]
            if not len(keys):
                break
            context = keys >> np.uint64(8)
            first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
            kinds = np.diff(np.r_[first, len(keys)]).astype(np.float64)
            total = np.add.reduceat(counts, first)
            own = np.repeat(np.arange(len(first)), kinds.astype(np.int64))
            new = {
                "grams": Table(keys), "contexts": Table(context[first]), "log": np.log10(counts - 0.5),
                "plain": np.log10((counts - 0.5) / total[own]), "escape": np.log10(kinds / 2 / total),
                "counts": counts, "total": total, "kinds": kinds,
            }
            if below is not None:
                # the next shorter context without the bytes that were seen here
                low = below["contexts"].find(context[first] & np.uint64((1 << 8 * (j - 1)) - 1))
                seen = below["counts"][below["grams"].find(keys & np.uint64((1 << 8 * j) - 1))]
                fresh = (below["kinds"][low] - kinds) / 2
                mass = np.maximum(below["total"][low] - np.add.reduceat(seen, first), 1e-300)
                new["excluded"], new["again"] = np.log10(mass), np.where(fresh > 0, np.log10(np.maximum(fresh, 1e-300) / mass), 0.0)
            self.levels.append(new)
            below = new

    def score(self, code: np.ndarray) -> np.ndarray:
        """The logarithm of the probability of each byte in its context."""
        out = np.zeros(len(code))
        left, from_ = np.arange(len(code)), np.full(len(code), -1, np.int64)  # the context escaped from, one level up
        for j in range(len(self.levels) - 1, -1, -1):
            level = self.levels[j]
            mine = code[left] & np.uint64((1 << 8 * (j + 1)) - 1)
            found = level["grams"].find(mine)
            hit, plain = found >= 0, from_ < 0
            a = hit & plain
            out[left[a]] += level["plain"][found[a]]
            b = hit & ~plain
            if b.any():
                out[left[b]] += level["log"][found[b]] - self.levels[j + 1]["excluded"][from_[b]]
            left, from_, mine, plain = left[~hit], from_[~hit], mine[~hit], plain[~hit]
            if not len(left):
                return out
            context = level["contexts"].find(mine >> np.uint64(8)).astype(np.int64)
            start = plain & (context >= 0)
            out[left[start]] += level["escape"][context[start]]
            on = ~plain
            if on.any():
                out[left[on]] += self.levels[j + 1]["again"][from_[on]]
            from_ = context
        unseen = 256 - (self.levels[0]["kinds"][0] if self.levels else 0)
        out[left] -= np.log10(max(unseen, 1))
        return out


# ---- scores ------------------------------------------------------------------------


def score(docs: DataFrame, model: dict, held_out: str | None = None, most: int = PART) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row.

    ``base_score`` sums log10((c + 1) / (N + V + 1)) over the words and the end, with c the
    count of a token, N of all and V of different ones in training. ``score`` is the logarithm
    of what the trie gives the words, one space between them, and the end. ``held_out`` names
    a column to be carried along.

    A null or empty text is its end alone. Rows are scored one by one: repeated rows repeat, and
    a null ``doc_id`` stays null. Without any training text all bytes are equally likely.
    """
    spark = docs.sparkSession
    n, v, order = model["tokens"], model["types"], model["order"]
    often = model["words"].where((F.col("n") >= FREQUENT * max(n, 1)) | (F.col("word") == F.lit(bytearray(b"\xff"))))
    log_all = float(np.log10(n + v + 1))
    # at most 1 / FREQUENT words
    common = spark.sparkContext.broadcast({bytes(r["word"]): float(np.log10(r["n"] + 1)) - log_all for r in often.toLocalIterator()})

    def of_words(texts: list[list[bytes]]) -> dict[str, list]:
        values_of = common.value
        end = values_of.get(b"\xff", -log_all)
        out: dict[str, list] = {"n_tokens": [], "known": [], "base": [], "rare": []}
        for ws in texts:
            values = [values_of[w] for w in ws if w in values_of]
            seldom = Counter([w for w in ws if w not in values_of]) if len(values) < len(ws) else {}
            out["n_tokens"].append(len(ws) + 1)
            out["known"].append(len(values) + (b"\xff" in values_of))
            out["base"].append(sum(values) + end)
            out["rare"].append([{"word": w, "times": k} for w, k in seldom.items()])
        return out

    def scored_by(part: DataFrame, ends: np.ndarray | None, carried: list[str], with_words: bool):
        grams = part.toArrow()  # a part: PART grams, or those of one end
        sent = spark.sparkContext.broadcast((order, *(grams[c].to_numpy() for c in ("level", "gram", "n"))))
        built: list[Model] = []

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            if not built:
                built.append(Model(*sent.value))
            mine = None
            if ends is not None:
                mine = np.zeros(1 << 16, bool)
                mine[ends] = True
            for b in batches:
                # a few texts at a time: what is held grows with these, not with the batch
                sizes = np.array([len(t or "") for t in b["text"]], np.int64)
                for _, some in b.groupby(np.cumsum(sizes) // BLOCK, sort=True):
                    texts = [words_of(t) for t in some["text"]]
                    scores: list[float] = []
                    for block in _blocks([b" ".join(ws) for ws in texts]):
                        c, starts = codes(block, order)
                        each = np.zeros(len(c))
                        real = c != np.uint64(2**64 - 1)
                        if mine is not None:
                            real &= mine[(c >> np.uint64(8) & np.uint64(0xFFFF)).astype(np.int64)]
                        real = np.flatnonzero(real)
                        each[real] = built[0].score(c[real])
                        scores.extend(np.add.reduceat(each, starts).tolist())
                    out = some[carried].assign(score=scores)
                    yield out.assign(**of_words(texts)) if with_words else out

        return run

    carried = ["doc_id"] + ([held_out] if held_out else [])
    # ids travel as text: in pandas numbers beside a null are floats
    fields = "doc_id string" + (f", {held_out} boolean" if held_out else "")
    of_text = "score double, n_tokens long, known long, base double, rare array<struct<word: binary, times: int>>"
    texts = docs.select(F.col("doc_id").cast("long").cast("string"), *([held_out] if held_out else []), "text")
    served = parts(model["trie"], most)
    if len(served) > 1:
        texts = materialise(texts.withColumn("row", F.monotonically_increasing_id()), "texts")
        rows = texts.mapInPandas(scored_by(*served[0], [*carried, "row"], True), f"{fields}, row long, {of_text}")
    else:
        rows = texts.mapInPandas(scored_by(*served[0], carried, True), f"{fields}, {of_text}").withColumn("row", F.monotonically_increasing_id())
    rows = materialise(rows.withColumn("doc_id", F.col("doc_id").cast("long")), "scores")
    if len(served) > 1:
        more = [materialise(texts.mapInPandas(scored_by(p, ends, ["row"], False), "row long, score double"), "part-scores") for p, ends in served[1:]]
        more = reduce(DataFrame.unionByName, more).groupBy("row").agg(F.sum("score").alias("further"))
        rows = rows.join(more, "row").withColumn("score", F.col("score") + F.col("further")).drop("further")
    seldom = rows.select("row", F.inline("rare")).join(model["words"], "word", "left")
    seldom = seldom.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).cast("long").alias("more"),
        F.sum(F.col("times") * (F.log10(F.coalesce("n", F.lit(0)) + 1) - F.lit(log_all))).alias("rest"),
    )
    zero = F.lit(0.0)
    return rows.drop("rare").join(seldom, "row", "left").select(
        *carried,
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest", zero)).alias("base_score"),
        "score",
    )


def score_held_out(docs: DataFrame, order: int = ORDER, most: int = PART) -> DataFrame:
    """Scores of all ``docs`` by a model of those whose CRC-32 of the id as text is not 2 modulo 7."""
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % MODULUS
    docs = docs.select("doc_id", "text", (fold == HELD_OUT).alias("held_out"))
    return score(docs, train(docs.where(~F.col("held_out")), order), "held_out", most)
