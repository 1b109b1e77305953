"""Benchmark contamination by winnowing.

Two texts that share a span of words share a fingerprint of it: of the hashes of all k-grams in
any ``span`` consecutive words the least is kept, so whoever has the span keeps the same one. The
fingerprints of documents and of benchmark items are joined, and hits are extended: every
window through a hit is compared as text with the windows of the benchmark. A frequent k-gram
thus costs each document a few look-ups, never a pair with each item that has it.

Most fingerprints of documents never leave their task, as a Bloom filter of bounded size tells
that no item has them. It decides nothing else: what it lets through is joined exactly, so
a benchmark too large for it only makes the join larger.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import materialise

#: words of a window, and of a k-gram; shorter items are one window
SPAN = 10
GRAM = 6
#: bits of the Bloom filter for each fingerprint, and of it all (8 MB)
BLOOM_SHARE = 64
BLOOM_BITS = 1 << 26
#: bytes of text that are worked on at a time; a longer word is hashed on its own
BLOCK = 1 << 20

#: lower-case letters, digits and all beyond ASCII as they are, A-Z lowered, anything else zero
_BYTES = np.array([b if b > 127 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 0 for b in range(256)], np.uint8)
_BASE = 0x9E3779B97F4A7C15
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_powers: list[np.ndarray] = []


def _power_tables() -> list[np.ndarray]:
    """Powers of an odd number modulo 2^64, and of its inverse."""
    if not _powers:
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(BLOCK + 1, base, np.uint64)
            table[0] = 1
            _powers.append(np.multiply.accumulate(table))
    return _powers


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def words_in(data: np.ndarray, breaks: np.ndarray, table: np.ndarray = _BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes by ``table``, and starts, ends and hashes of the words; none runs across one of ``breaks``.

    ``table`` says what each byte counts as, zero for what parts words.
    """
    low = table[data]
    inside = low != 0
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    b = breaks[(breaks > 0) & (breaks < len(low))]
    first[b], last[b - 1] = inside[b], inside[b - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = np.zeros(len(starts), np.uint64)
    up, down = _power_tables()
    at = 0
    while at < len(starts):
        base = starts[at]
        to = int(np.searchsorted(ends, base + BLOCK, "right"))
        if to <= at:  # one word fills the block
            hashes[at] = xxhash.xxh64_intdigest(low[base : ends[at]].tobytes())
            at += 1
            continue
        part = low[base : ends[to - 1]].astype(np.uint64)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part * up[: len(part)])))
        s, e = starts[at:to] - base, ends[at:to] - base
        hashes[at:to] = (sums[e] - sums[s]) * down[s]
        at = to
    return low, starts, ends, _mixed(hashes)


def winnow(hashes: np.ndarray, text: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the k-grams that are kept: the least of each ``span`` words, the last of equal ones.

    ``text`` numbers the text of each word, ascending; spans lie within a text.
    """
    k = min(gram, span)
    n = len(hashes) - span + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = np.zeros(len(hashes) - k + 1, np.uint64)
    for j in range(k):
        grams = grams * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[j : len(grams) + j]
    grams = _mixed(grams)
    best, place = grams[:n].copy(), np.zeros(n, np.int16)
    for j in range(1, span - k + 1):
        new = grams[j : n + j]
        less = new <= best
        best[less] = new[less]
        place[less] = j
    whole = np.flatnonzero(text[:n] == text[span - 1 :])
    kept = np.zeros(len(grams), bool)
    kept[whole + place[whole]] = True
    at = np.flatnonzero(kept)
    return at, grams[at]


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column and where each starts, without a copy."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets
    return np.frombuffer(data, np.uint8), offsets


def _parts(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about a block."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK, "right")) - 1)
        yield at, min(to, n)
        at = to


def _scan(spans: list[int], gram: int, ask) -> object:
    """Rows of (id, number of words, kept k-grams that pass ``ask``, with the words around them)."""
    found_type = pa.list_(pa.struct([("span", pa.int32()), ("gram", pa.int64()), ("at", pa.int64()), ("words", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = ask()
        for b in batches:
            data, offsets = _buffers(b.column(1))
            counts, found = [], []
            for a, z in _parts(offsets):
                cuts = offsets[a : z + 1] - offsets[a]
                low, starts, ends, hashes = words_in(data[offsets[a] : offsets[z]], cuts)
                text = np.searchsorted(cuts, starts, "right") - 1
                bounds = np.searchsorted(starts, cuts)
                # empty texts share a cut with their successor, whose words are not theirs
                counts.extend(np.diff(bounds).tolist())
                mine: list[list] = [[] for _ in range(z - a)]
                for span in spans:
                    k = min(gram, span)
                    places, grams = winnow(hashes, text, span, gram)
                    ok = passes(grams)
                    for i, g in zip(places[ok].tolist(), grams[ok].view(np.int64).tolist()):
                        t = text[i]
                        begin, end = max(bounds[t], i - span + k), min(bounds[t + 1], i + span)
                        around = b" ".join([low[starts[j] : ends[j]].tobytes() for j in range(begin, end)])
                        mine[t].append({"span": span, "gram": g, "at": int(begin - bounds[t]), "words": around})
                found.extend(mine)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(counts, pa.int64()), pa.array(found, found_type)], ["id", "n_words", "found"]
            )

    return run


def _schema(id_type: T.DataType) -> T.StructType:
    found = T.StructType().add("span", "integer").add("gram", "long").add("at", "long").add("words", "binary")
    return T.StructType().add("id", id_type).add("n_words", "long").add("found", T.ArrayType(found))


def benchmark_words(text: Column) -> Column:
    """The words of a text: runs of digits, letters a-z and anything beyond ASCII, A-Z lowered."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())
    return F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _windows(items: DataFrame, span: int) -> DataFrame:
    """``item`` (as text), ``span`` and ``window`` of every item, without repeats."""
    w = items.select(F.col("item_id").cast("string").alias("item"), benchmark_words(F.col("text")).alias("w")).where(F.size("w") > 0)
    w = w.withColumn("span", F.least(F.size("w"), F.lit(span)))
    each = F.transform(F.sequence(F.lit(1), F.size("w") - F.col("span") + 1), lambda i: F.array_join(F.slice("w", i, F.col("span")), " "))
    return w.select("item", "span", F.explode(each).alias("window")).distinct()


def _bloom(grams: DataFrame) -> np.ndarray:
    """A bit for each fingerprint, as bytes; the number of bits is a power of two within ``BLOOM_BITS``."""
    n = grams.count()
    bits = min(BLOOM_BITS, 1 << max(12, (n * BLOOM_SHARE - 1).bit_length()))
    place = F.col("gram").bitwiseAND(F.lit(bits - 1))
    words = grams.groupBy(F.shiftright(place, 5).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(31)).cast("int"))).alias("set")
    )
    table = words.toArrow()  # at most a 32nd of BLOOM_BITS rows, whatever the benchmark
    out = np.zeros(bits // 32, np.uint32)
    out[table["word"].to_numpy()] = table["set"].to_numpy().astype(np.uint32)
    return out


def contamination(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_hit``, ``items`` and ``spans`` of every row of ``docs``.

    A window is ``span`` consecutive words of an item, or all words of a shorter one. Words of a
    document that lie in an occurrence of a window are hit: ``n_hit`` counts them, ``spans`` lists
    the stretches of them as (start, end) in words. ``items`` holds the ids, as sorted text, of
    the items of which a window occurs.

    ``docs`` needs ``doc_id`` and ``text``, ``items`` ``item_id`` and ``text``; other columns are
    ignored. Null and empty texts have no words: such items occur nowhere. Items
    without an id hit words but are not listed; repeated items are listed once. Rows of
    ``docs`` are judged one by one, so repeated rows repeat and a null ``doc_id`` stays null.
    """
    spark = docs.sparkSession
    windows = materialise(_windows(items, span), "benchmark-windows")
    spans = sorted(r["span"] for r in windows.select("span").distinct().collect())  # at most ``span`` numbers

    everything = lambda: lambda grams: np.ones(len(grams), bool)
    own = windows.select(F.col("span").cast("long").alias("id"), F.col("window").alias("text"))
    own = own.mapInArrow(_scan(spans, gram, everything), _schema(T.LongType())).select(F.col("id").cast("int").alias("own"), F.inline("found"))
    grams = materialise(own.where("own = span").select("span", "gram").distinct(), "benchmark-fingerprints")
    bloom = spark.sparkContext.broadcast(_bloom(grams))

    def filtered():
        bits = bloom.value
        mask = np.uint64(len(bits) * 32 - 1)
        return lambda grams: (bits[(grams & mask) >> np.uint64(5)] >> (grams & np.uint64(31)).astype(np.uint32)) & 1 != 0

    kind = docs.schema["doc_id"].dataType
    scanned = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(_scan(spans, gram, filtered), _schema(kind))
    rows = materialise(scanned.withColumn("row", F.monotonically_increasing_id()), "document-fingerprints")

    hits = rows.select("row", F.inline("found")).join(grams, ["span", "gram"], "left_semi")
    hits = hits.withColumn("w", F.split(F.col("words").cast("string"), " "))
    each = F.transform(
        F.sequence(F.lit(0), F.size("w") - F.col("span")),
        lambda i: F.struct((F.col("at") + i).alias("start"), F.array_join(F.slice("w", i + 1, F.col("span")), " ").alias("window")),
    )
    met = hits.select("row", "span", F.inline(each)).join(windows.select("span", "window").distinct(), ["span", "window"], "left_semi")
    met = materialise(met.distinct(), "benchmark-hits")

    # the stretches: a window opens one where it starts behind all ends so far
    ends = F.max("end").over(Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    one = met.select("row", "start", (F.col("start") + F.col("span")).alias("end")).withColumn("open", F.coalesce(F.col("start") > ends, F.lit(True)))
    one = one.withColumn("n", F.count(F.when(F.col("open"), 1)).over(Window.partitionBy("row").orderBy("start", "end")))
    one = one.groupBy("row", "n").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    one = one.groupBy("row").agg(F.sum(F.col("end") - F.col("start")).alias("n_hit"), F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    listed = met.select("row", "span", "window").distinct().join(windows, ["span", "window"]).groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items"))

    no_items, no_spans = F.array().cast("array<string>"), F.array().cast("array<struct<start: bigint, end: bigint>>")
    return (
        rows.select("row", F.col("id").alias("doc_id"), "n_words")
        .join(one, "row", "left")
        .join(listed, "row", "left")
        .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", no_items).alias("items"), F.coalesce("spans", no_spans).alias("spans"))
    )
