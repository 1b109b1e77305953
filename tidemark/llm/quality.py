"""Quality rules: lines are judged first, then the document by what is left of it.

Every line with a word is tested on its own for punctuation, navigation and boilerplate.
Lines that fail are removed, and a document that loses too much of its text goes. Four
base figures of the whole text are kept beside the verdict.

Everything is one projection of built-in functions: no shuffle, so a hot source or a
group of copies costs what its rows cost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, temporary, words_of

#: words in a window that counts as repeated if the text has it again
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30

#: characters that prose has few of
SYMBOLS = "#*$%&|<>"
#: a line of prose ends like this, closing quotes and brackets aside, or, cut short, has two sentences inside
SENTENCE_END = r"[.!?…:;,。！？][\"'”’»)\]]*\s*$|[.!?…]\s.*[.!?…]\s"
#: more of a line's characters than this are symbols, or it shouts: it fails for punctuation
MAX_SYMBOL_PERCENT = 10
SHOUTING = r"!!|\?\?\?|(?:[-_=~.·•]){5,}"
#: items set apart by marks, or the words of a menu
NAVIGATION = r"(?:[|»›•·→][^|»›•·→]*){2,}|(?i:^\s*(?:home|menu|next|previous|back|login|log in|sign in|sign up|search|share|tweet)\s*$)"
#: fixed phrases of pages, not of articles
BOILERPLATE = (
    r"(?i:cookies? (?:policy|settings)|use of cookies|uses cookies|accept (?:all )?cookies|enable javascript|privacy policy|"
    r"terms of (?:use|service)|all rights reserved|lorem ipsum|click here|subscribe to our|sign up for our|"
    r"follow us on|share this (?:page|article)|read more (?:at|on)|skip to (?:main )?content)"
)
#: a document is rejected if its removed lines hold more of its characters than this
MAX_LOST_PERCENT = 50


def _line_reason(line: Column) -> Column:
    """The first rule a line fails, or null."""
    dense = F.length(F.regexp_replace(line, SPACE + "+", ""))
    symbols = F.length(F.regexp_replace(line, f"[^{SYMBOLS}]+", ""))
    return (
        F.when(line.rlike(BOILERPLATE), "boilerplate")
        .when(line.rlike(NAVIGATION), "navigation")
        .when((symbols * 100 > dense * MAX_SYMBOL_PERCENT) | line.rlike(SHOUTING), "punctuation")
        .when(~line.rlike(SENTENCE_END), "punctuation")
    )


def judge(
    docs: DataFrame,
    text: str = "text",
    min_words: int = MIN_WORDS,
    max_repeated_percent: int = MAX_REPEATED_PERCENT,
    max_lost_percent: int = MAX_LOST_PERCENT,
) -> DataFrame:
    """The rows of ``docs`` with the figures and the verdict as columns.

    Adds ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``n_lines`` (those with a word), ``n_lines_removed``, ``lost_chars`` (not white space, in
    removed lines), ``clean_text`` (the lines that stay, joined by \\n), ``base_failed`` and
    ``kept``. Columns of the same names are replaced; all others stay.

    A null or empty text has no words: every figure is 0, ``clean_text`` is empty, the base
    rules fail and it is not kept. Rows are judged one by one, so repeated rows repeat.
    Repeated windows are found by a 64-bit hash of their words; no text is too long.
    """
    names = ("words", "lines", "grams", "order", "pos", "good", "text", "task")
    words, lines, grams, order, pos, good, said, task = temporary(*names)
    n = F.size(words)
    df = docs.withColumn(said, F.coalesce(F.col(text), F.lit(""))).withColumn(words, words_of(F.col(said)))

    # Windows as hashes; only texts that have one twice go on to the positions of these.
    windows = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    df = df.withColumn(grams, F.when(n > WINDOW, windows))
    numbered = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    df = df.withColumn(order, F.when(F.size(F.array_distinct(grams)) < F.size(grams), numbered))
    again = F.filter(
        order,
        lambda x, i: (F.get(F.col(order), i + 1)["g"] == x["g"])
        | ((i > 0) & (F.get(F.col(order), F.greatest(i - 1, F.lit(0)))["g"] == x["g"])),
    )
    df = df.withColumn(pos, F.sort_array(F.transform(again, lambda x: x["i"])))
    covered = F.aggregate(
        pos,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")),
    )["n"]

    # Lines: those with a word, each with the rule it fails.
    with_word = F.filter(F.split(F.col(said), "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]"))
    df = df.withColumn(lines, with_word).withColumn(good, F.filter(lines, lambda x: _line_reason(x).isNull()))

    def dense(of: Column) -> Column:
        return F.length(F.array_join(of, "")).cast("long")

    joined, kept_lines = F.array_join(words, ""), F.array_join(good, "\n")
    out = {
        "n_words": n.cast("long"),
        "word_chars": F.length(joined).cast("long"),
        "n_symbols": F.length(F.regexp_replace(joined, f"[^{SYMBOLS}]+", "")).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_lines_removed": (F.size(lines) - F.size(good)).cast("long"),
        "lost_chars": F.length(joined) - F.length(F.regexp_replace(F.array_join(good, ""), SPACE + "+", "")).cast("long"),
        "clean_text": kept_lines,
    }
    keep = [c for c in docs.columns if c not in {*out, "base_failed", "kept"}]
    # A filter on the verdict must not be pushed below this: it would spell out every step again, inside
    # each other's loops. The number of the task, which the optimiser takes for random, holds it back.
    held = F.spark_partition_id().alias(task)
    df = df.select(*[F.col(f"`{c}`") for c in keep], *[v.alias(k) for k, v in out.items()], held)
    failed = (F.col(task) < 0) | (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeated_percent * F.col("n_words"))
    lost = 100 * F.col("lost_chars") > max_lost_percent * F.col("word_chars")
    return df.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~lost).drop(task)


def keep_good(docs: DataFrame, **rules: int) -> DataFrame:
    """The documents that pass, with the text that is left and its length; columns as they came.

    Needs the columns ``text`` and ``n_chars``.
    """
    judged = judge(docs, **rules).where("kept")
    return judged.withColumn("text", F.col("clean_text")).withColumn(
        "n_chars", F.length("clean_text").cast(docs.schema["n_chars"].dataType)
    ).select(*[f"`{c}`" for c in docs.columns])
