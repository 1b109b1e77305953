"""Token counts that equal the library's on the whole text, whatever its length.

A huge document is not encoded at once but in overlapping chunks, with the offsets of their
tokens. Where two chunks overlap, the earlier one is right up to its cut-off end, and the later
one from the first place where both start a word: from there on both see the same text and
have no memory. The count of one is spliced to that of the other there. If they agree on no
such place, the overlap is widened and the chunk encoded anew.

Short documents are one chunk; pieces met before are not encoded again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidemark.llm.memo import PieceCounts, open_tokenizer

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
#: characters of a chunk, and of the text two chunks share at first
CHUNK = 1 << 16
OVERLAP = 1 << 10
#: a cut end can spoil the words before it: a contraction, a special string or white space that goes on
SPOILT_WORDS = 4
SPOILT_CHARS = 64
#: words that must agree behind a place before it is trusted
AGREEING = 8
#: texts that are encoded at a time, in characters
CHARS = 1 << 22

_workers: dict[str, PieceCounts] = {}


def _starts(tokenizer: Tokenizer, text: str) -> tuple[int, list[tuple[int, int, int]], list[int]]:
    """The number of tokens; of each token that starts a word its (start, end, number); and all ids."""
    e = tokenizer.encode(text, add_special_tokens=False)
    offsets, words = e.offsets, e.word_ids
    out = []
    for i, w in enumerate(words):
        # a special string has no word; neighbours of one are told apart by it
        if (i == 0 or w is None or w != words[i - 1]) and offsets[i][0] < offsets[i][1]:
            out.append((*offsets[i], i))
    return len(e.ids), out, e.ids


def _splice(a_at: int, a: tuple, a_end: int, b_at: int, b: tuple, last: bool) -> tuple[int, int] | None:
    """Token numbers in a and b of the first place where both start the same word, or None.

    Chunk a starts at ``a_at`` and ends at ``a_end``, chunk b starts at ``b_at``. Words of a that
    its end may have spoilt don't count.
    """
    _, starts_a, ids_a = a
    _, starts_b, ids_b = b
    sure = len(starts_a) if last else len(starts_a) - SPOILT_WORDS
    there = {b_at + s: (t, i) for s, t, i in starts_b}
    trusted = [x for x in starts_a[: max(0, sure)] if x[1] + a_at <= a_end - SPOILT_CHARS and x[0] + a_at > b_at]
    for s, _, i in trusted[: len(trusted) - AGREEING]:
        found = there.get(a_at + s)
        if found is None:
            continue
        j, until = found[1], trusted[-1][2]
        if ids_a[i:until] == ids_b[j : j + until - i]:
            return i, j
    return None


def count_huge(tokenizer: Tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """The number of tokens of the whole text, by chunks."""
    if len(text) <= chunk:
        return len(tokenizer.encode(text, add_special_tokens=False).ids)
    at, end, total = 0, chunk, 0
    current, skip = _starts(tokenizer, text[:chunk]), 0  # tokens of the current chunk that are counted already
    while end < len(text):
        shared, met = overlap, None
        while met is None:
            start = max(at, end - shared)
            if start == at:  # all of the current chunk would be encoded again: go on from its start, further
                end = min(len(text), end + chunk)
                current = _starts(tokenizer, text[at:end])
                if end == len(text):
                    break
                shared = overlap
                continue
            nxt = _starts(tokenizer, text[start : start + max(chunk, 2 * shared)])
            met = _splice(at, current, end, start, nxt, last=False)
            if met is None:
                shared *= 2
        if met is None:
            break
        total += met[0] - skip
        skip = met[1]
        at, end, current = start, min(len(text), start + max(chunk, 2 * shared)), nxt
    return total + current[0] - skip


def _counter(vocabulary: str) -> PieceCounts:
    if vocabulary not in _workers:
        _workers[vocabulary] = PieceCounts(open_tokenizer(vocabulary))
    return _workers[vocabulary]


def count_tokens(
    docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """``docs`` with ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    Counts are those of the library on the whole text, without begin, end or added special
    tokens; special strings in a text count as it counts them by default. ``docs`` needs
    ``text``; columns with the names of results are replaced, all others stay. A null or empty
    text has no bytes and no tokens. Rows are counted one by one, so repeated rows repeat.
    """
    kept = [c for c in docs.columns if c not in ("n_bytes", "n_tokens", "over_limit")]
    docs = docs.select(*[f"`{c}`" for c in kept])
    schema = T.StructType([*docs.schema.fields, T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    at = kept.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(vocabulary)
        for b in batches:
            texts = [t or "" for t in b.column(at).to_pylist()]
            counts, some, chars = [0] * len(texts), [], 0
            for i, t in enumerate(texts):
                if len(t) > chunk:
                    counts[i] = count_huge(counter.tokenizer, t, chunk, overlap)
                    continue
                some.append(i)
                chars += len(t)
                if chars > CHARS:
                    for k, n in zip(some, counter.count([texts[k] for k in some])):
                        counts[k] = n
                    some, chars = [], 0
            for k, n in zip(some, counter.count([texts[k] for k in some])):
                counts[k] = n
            new = [pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays([*b.columns, *new], [*b.schema.names, "n_bytes", "n_tokens"])

    return docs.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)
