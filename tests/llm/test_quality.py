import re

from tidemark.llm import quality

SPACE = re.compile(r"[ \t\n\x0b\f\r]+")


def brute(text):
    words = [w for w in SPACE.split(text or "") if w]
    lines = [x for x in (text or "").split("\n") if SPACE.sub("", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    hit = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(hit),
        "n_lines": len(lines),
    }


GOOD = "This is a plain sentence with enough words to be read as prose by anyone at all."
TEXTS = [
    None,
    "",
    " \n\t",
    GOOD + " It goes on for a while, so that the text has more than twenty words.",
    "a b c d e f g h " * 9,
    "\n".join([GOOD, GOOD, "x"]),
    "😀 *** ### $ é\x0bword\fthere\r\n" + GOOD,
    "one two three four five six seven eight nine one two three four five six seven eight",
    "\n".join([GOOD, "We use cookies. Accept all cookies now.", "Home | News | Sport | More", "No end of a line", GOOD + " And on."]),
    "word " * 8,
    "w%d. " * 30000 % tuple(range(30000)),
]


def test_figures_equal_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)) + [(8, TEXTS[8])], "doc_id long, text string").selectExpr("*", "1 AS kept", "'q' AS clean_text")
    rows = quality.judge(df).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        if r["doc_id"] != 10:
            want = brute(TEXTS[r["doc_id"]])
            assert {k: r[k] for k in want} == want, r["doc_id"]
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
    by = {r["doc_id"]: r for r in rows}
    assert by[10]["n_words"] == 30000 and by[10]["n_repeat_words"] == 0
    assert not by[0]["kept"] and by[0]["clean_text"] == ""
    assert by[3]["kept"] and not by[4]["kept"]
    assert by[8]["clean_text"] == TEXTS[8].split("\n")[0] + "\n" + TEXTS[8].split("\n")[4]
    assert by[8]["n_lines_removed"] == 3


def test_documents_that_lose_too_much_go(spark):
    menu = "\n".join("Home | News | Sport | More" for _ in range(10))
    rows = [(1, f"{GOOD} Then some other words follow, and more of it.", 5), (2, f"{GOOD}\n{GOOD[5:]}\n{menu}", 5), (3, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars int")
    kept = quality.keep_good(df)
    assert kept.columns == df.columns and kept.dtypes == df.dtypes
    assert [(r["doc_id"], r["n_chars"]) for r in kept.collect()] == [(1, len(rows[0][1]))]
    assert quality.judge(df.limit(0)).count() == 0


def test_a_filter_on_the_verdict_stays_above_the_figures(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").selectExpr("*", "1 AS n_chars")
    plan = quality.keep_good(df)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if line.strip(" +-:").startswith("Filter")]
    assert filters and not any("xxhash64" in line for line in filters)
