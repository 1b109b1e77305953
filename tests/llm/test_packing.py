import random
import zlib
from collections import defaultdict

import numpy as np

from tidemark.llm import packing
from tidemark.llm.memo import WordIds, open_tokenizer

ODD = [
    None, "", "   ", "Hello, World! it's 3pm.", "a<|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|> x<|", "É é, ́a *** word*** '' x's, don't.",
    "tab\there\x0band\x1cthere\x85nbsp\xa0wide　end", "😀😀 日本語。text", "word " * 20000, "x" * 9000, "ﬁne ＡＢＣ İstanbul ΣΑΣ",
]


def texts(seed=4):
    rng = random.Random(seed)
    signs = "ab'Z1é,.*<|> \n\t́\xa0-"
    out = list(ODD) + ["".join(rng.choice(signs) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    out += [" ".join(rng.choice(["the", "tion", "Ondre,", "heed.", "wh***"]) for _ in range(rng.randint(1, 3000))) for _ in range(80)]
    return out


def test_words_give_the_ids_of_the_library():
    library, own = open_tokenizer(packing.VOCABULARY), WordIds(packing.VOCABULARY)
    ts = [t or "" for t in texts()]
    for t, e in zip(ts, own.encode(ts)):
        assert np.frombuffer(e, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t[:80]


def test_every_id_lies_in_one_piece_and_sequences_are_full(spark):
    library = open_tokenizer(packing.VOCABULARY)
    rows = list(enumerate(texts())) + [(5, "Hello, World! it's 3pm.")]
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, length int, tier string").repartition(3)
    got = packing.pack(df, pool=20_000, step=8192).toPandas()
    ids = {i: library.encode(t or "", add_special_tokens=False).ids + [2] for i, t in rows[:-1]}
    spans = defaultdict(list)
    for r in got.itertuples():
        if r.doc_id != 5:
            data = ids[r.doc_id]
            spans[r.doc_id].append((r.start, r.length))
            assert r.doc_tokens == len(data)
            assert r.ids_crc32 == zlib.crc32(np.array(data[r.start : r.start + r.length], "<u4").tobytes())
    for i, data in ids.items():
        at = 0
        for start, length in sorted(spans[i]) if i != 5 else []:
            assert start == at and length > 0
            at += length
        assert at == len(data) or i == 5
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert (s["offset"].to_numpy() == np.cumsum(s["length"]) - s["length"]).all()
        total = int(s["length"].sum())
        assert total == s["tier"].iloc[0] <= 4096 and total & (total - 1) == 0
    assert got.groupby("sequence_id")["step_group"].nunique().max() == 1
    # most documents are not cut
    assert np.mean([len(v) == 1 for k, v in spans.items() if len(ids[k]) <= 2048]) > 0.8
    # full groups hold about a step
    loads = got.groupby("step_group")["length"].sum()
    assert loads.max() < 2 * 8192


def test_missing_ids_and_an_empty_table(spark):
    df = spark.createDataFrame([(None, "some text"), (None, None)], "doc_id long, text string")
    got = packing.pack(df).toPandas()
    assert got["doc_id"].isna().all() and got["length"].sum() == got.groupby("doc_tokens")["length"].sum().sum()
    assert packing.pack(df.limit(0)).count() == 0
