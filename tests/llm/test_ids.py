"""Ids beyond what a float holds, next to a null, through every operator that goes by way of pandas or Arrow."""

import pytest

from tidemark.llm import licences, packing, ppm, simhash, tokens, warc, wrappers

BIG = 2**53 + 1
NOTICE = next(iter(licences.TEMPLATES.values()))

DOCUMENTS = {
    "tokens": lambda d: tokens.count_tokens(d),
    "packing": lambda d: packing.pack(d),
    "ppm": lambda d: ppm.score_held_out(d),
    "simhash": lambda d: simhash.near_duplicates(d),
    "keep_one": lambda d: simhash.keep_one(d),
    "licences": lambda d: licences.scan_licenses(d),
}


@pytest.mark.parametrize("name", DOCUMENTS)
def test_ids_of_documents(spark, name):
    df = spark.createDataFrame([(BIG, NOTICE), (None, NOTICE + " and more"), (-BIG, NOTICE)], "doc_id long, text string").coalesce(1)
    got = {r["doc_id"] for r in DOCUMENTS[name](df).collect()}
    assert got == ({-BIG, None} if name == "keep_one" else {BIG, -BIG, None})


def test_component_ids(spark):
    df = spark.createDataFrame([(BIG, NOTICE), (BIG + 2, NOTICE), (None, NOTICE)], "doc_id long, text string").coalesce(1)
    assert {r["component_id"] for r in simhash.near_duplicates(df).collect()} == {BIG, None}


def test_ids_of_pages(spark):
    page = "<article><p>Some text.</p></article>"
    rows = [(BIG, "http://a.b/", page), (None, "http://a.b/c", page), (BIG + 1, None, page)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    assert {r["page_id"] for r in wrappers.extract(df).collect()} == {BIG, BIG + 1, None}
    got = {(r["page_id"], r["record_type"], r["refers_to"]) for r in warc.archive_and_read(df).collect()}
    assert got == {(BIG, "response", None), (BIG + 1, "revisit", BIG), (None, "response", None)}


def test_two_texts_under_one_id_both_stay(spark):
    texts = [" ".join(f"{w}{i}" for i in range(60)) for w in "ab"]
    df = spark.createDataFrame([(1, texts[0]), (1, texts[1]), (1, texts[1]), (2, texts[0])], "doc_id long, text string")
    assert sorted(map(tuple, simhash.keep_one(df).collect())) == [(1, texts[0]), (1, texts[1])]
