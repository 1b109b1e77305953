"""The whole pipeline, stage by stage, against what each stage promises of its own input."""

import zlib

import corpus_pipeline
import numpy as np
import pytest

from tidemark.llm import mixing, packing, quality, simhash
from tidemark.llm.common import materialise, table
from tidemark.llm.memo import open_tokenizer

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    docs, out = table(spark, FOLDER, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append((docs, docs := materialise(stage(spark, docs, FOLDER), name.replace(" ", "-"))))
    return out


def ids(df):
    return [r["doc_id"] for r in df.select("doc_id").collect()]


def test_all_but_the_last_stage_return_documents(spark, outputs):
    columns = table(spark, FOLDER, "documents").columns
    for before, after in outputs[:-1]:
        assert after.columns == columns and set(ids(after)) <= set(ids(before)) and len(ids(after)) == len(set(ids(after)))


def test_quality_rules_reject_what_they_judge_bad(outputs):
    before, after = outputs[0]
    verdicts = {r["doc_id"]: r["kept"] for r in quality.judge(before).select("doc_id", "kept").collect()}
    assert set(ids(after)) == {i for i, kept in verdicts.items() if kept}


def test_one_document_of_each_group_stays(outputs):
    before, after = outputs[1]
    groups = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(before).collect()}
    assert sorted(ids(after)) == sorted(set(groups.values()))


def test_mixing_keeps_texts_as_they_are(outputs):
    before, after = outputs[2]
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    assert 0 < after.count() <= before.count() and all(texts[r["doc_id"]] == r["text"] for r in after.collect())


def test_mixing_keeps_labelled_clean_documents(spark):
    """Behind the other filters hardly any low-quality text is left, so its target is out of reach; that costs no clean text."""
    folder = "/root/testdata/sf0.01"
    docs = table(spark, folder, "documents")
    for name, stage in corpus_pipeline.STAGES[:3]:
        before, docs = docs, materialise(stage(spark, docs, folder), name.replace(" ", "-"))
    clean = mixing.domains_of(table(spark, folder, "labels")).where("domain = 'clean'")
    n = before.join(clean, "doc_id").count()
    assert n > 200 and docs.join(clean, "doc_id").count() >= 0.98 * n


def test_every_token_is_packed_once(outputs):
    before, after = outputs[3]
    library, pieces = open_tokenizer(packing.VOCABULARY), {}
    for r in after.collect():
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    for r in before.collect():
        data = np.array(library.encode(r["text"] or "", add_special_tokens=False).ids + [packing.END], "<u4")
        at = 0
        for start, length, crc, total in sorted(pieces[r["doc_id"]]):
            assert start == at and total == len(data) and zlib.crc32(data[start : start + length].tobytes()) == crc
            at += length
        assert at == len(data)
    assert len(pieces) == before.count()
