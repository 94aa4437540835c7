"""Quality rules by line-first cleaning: lines are judged and removed before the document is.

Every line of a text that holds a word meets three groups of rules: punctuation (marks hung onto words, runs of ``!`` and
``?``, lines without a letter, long lines without any sentence mark), navigation (separators between words, short lines
that name parts of a site) and boilerplate (short lines with a fixed phrase). Failing lines go. A document is kept when it
passes the base limits on words and repeated windows and loses at most ``most_lost`` percent of the code points of its
words with the lines that go; a document that loses more is rejected, however good the rest of it is.

All of it is one projection of column expressions, without a shuffle: texts are not moved, and a row's work is in proportion
to its own text (windows are sorted, never compared pairwise). Equal windows are found by 64-bit hashes inside one text.

Cases: a null text counts as empty and an empty text has no words, so both fail the base limits and lose nothing; rows with a
null or repeated doc_id are judged each on its own; texts of any length are read whole; equal lines are equal code point by
code point, and lines without a word never fail; a share that meets a limit exactly is within it; columns of the input
other than doc_id and text are not looked at, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotrend.llm.common import ASCII_UPPER, SPACE, texts

# Fixed values of the contract: what counts as a symbol and the base limits.
SYMBOLS = r"[#*$%&|<>]"
LEAST_WORDS = 50
MOST_REPEATED = 50

#: Percent of the code points of its words that a document may lose with its lines.
MOST_LOST = 30
#: Symbols, and runs of marks, for every hundred words of a line.
MOST_SYMBOLS, MOST_MARKS = 30, 20
#: A line of so many words holds a sentence mark.
LONG_LINE = 30
#: Lines with navigational or boilerplate phrases fail up to so many words; longer ones are prose that mentions them.
SHORT_LINE, NOTICE_LINE = 10, 30
#: Separators for every hundred words of a navigation line.
MOST_SEPARATORS = 25

WORD = f"[^{SPACE}]+"
MARK_RUNS = r"[!?]{2,}"
SENTENCE_MARK = "[.!?:;…。！？]"
LETTER = r"\p{L}"
SEPARATOR = "[»›•·|>]"
NO_WORD = r"[^\p{L}\p{N}]"
SENTENCE_END = rf"[.!?][{SPACE}]*\z"
NAVIGATION = (
    "home|menu|site ?map|search|about us|contact us|log ?in|log ?out|sign ?in|sign ?up|register|next page|previous page|"
    "read more|show more|view all|click here|skip to content|back to top|share this|follow us|print this page"
)
BOILERPLATE = (
    "uses? cookies|accept (all )?cookies|cookie (policy|settings)|privacy policy|terms of (use|service)|all rights reserved|"
    "enable javascript|javascript is disabled|subscribe to our newsletter|unsubscribe|powered by|lorem ipsum|"
    "this page is under construction|advertisement"
)


def _holds(line: Column, phrases: str) -> Column:
    """Whether a line holds one of the phrases as whole words, A-Z like a-z."""
    lower = F.translate(line, ASCII_UPPER, ASCII_UPPER.lower())
    return lower.rlike(rf"(^|{NO_WORD})({phrases})({NO_WORD}|\z)")


def _windows(words: Column) -> Column:
    """Windows of three words as (hash, place), sorted."""
    window = lambda w, i: F.struct(F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i"))
    return F.sort_array(F.slice(F.transform(words, window), F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))))


def _covered(places: Column) -> Column:
    """Words that windows of three starting at the ascending ``places`` cover."""
    gap = lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3))).cast("long")
    return F.aggregate(F.transform(places, gap), F.lit(0).cast("long"), lambda total, n: total + n)


def _share_over(part: Column, whole: Column, percent: int) -> Column:
    return part * 100 > whole * percent


def failure(line: Column, n_words: Column) -> Column:
    """The first group of rules that a line fails, null for a line that stays."""
    symbols = F.regexp_count(line, F.lit(SYMBOLS))
    marks = F.regexp_count(line, F.lit(MARK_RUNS))
    separators = F.regexp_count(line, F.lit(SEPARATOR))
    punctuation = (
        _share_over(symbols, n_words, MOST_SYMBOLS)
        | _share_over(marks, n_words, MOST_MARKS)
        | ~line.rlike(LETTER)
        | ((n_words >= LONG_LINE) & ~line.rlike(SENTENCE_MARK))
    )
    navigation = ((separators >= 2) & _share_over(separators, n_words, MOST_SEPARATORS)) | (
        (n_words <= SHORT_LINE) & ~line.rlike(SENTENCE_END) & _holds(line, NAVIGATION)
    )
    boilerplate = (n_words <= NOTICE_LINE) & _holds(line, BOILERPLATE)
    reason = F.when(navigation, "navigation").when(boilerplate, "boilerplate").when(punctuation, "punctuation")
    return F.when(n_words > 0, reason)


def clean(docs: DataFrame, most_lost: int = MOST_LOST) -> DataFrame:
    """Every document with its measures, its cleaned text and the verdict.

    ``doc_id``; ``text`` without the failing lines; ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words`` of the whole text; ``n_punctuation``, ``n_navigation``, ``n_boilerplate`` lines removed, and
    ``lost_chars`` of words in them; ``base_failed`` and ``kept``.
    """
    total = lambda array: F.aggregate(array, F.lit(0).cast("long"), lambda acc, n: acc + n)

    cut = texts(docs).select(
        "doc_id",
        F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.split("text", "\n", -1).alias("lines"),
    )
    line_words = lambda line: F.regexp_count(line, F.lit(WORD))
    line_chars = lambda line: F.length(F.regexp_replace(line, F.lit(f"[{SPACE}]+"), F.lit("")))
    judged = cut.select(
        "doc_id",
        "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        total(F.transform("words", lambda w: F.length(w).cast("long"))).alias("word_chars"),
        _windows(F.col("words")).alias("windows"),
        F.transform("lines", lambda x: F.struct(x.alias("line"), line_words(x).alias("n"))).alias("lines"),
    )
    same = lambda x, other: F.coalesce(x["h"] == other["h"], F.lit(False))
    windows = F.col("windows")
    twice = F.filter(windows, lambda x, i: same(x, F.get(windows, i + 1)) | ((i > 0) & same(x, F.get(windows, i - 1))))
    with_word = F.transform(F.filter("lines", lambda x: x["n"] > 0), lambda x: x["line"])
    judged = judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        F.sort_array(F.transform(twice, lambda x: x["i"])).alias("places"),
        with_word.alias("with_word"),
        F.transform("lines", lambda x: F.struct(x["line"].alias("line"), failure(x["line"], x["n"]).alias("why"))).alias("lines"),
    )
    failing = F.filter("lines", lambda x: x["why"].isNotNull())
    removed = lambda why: F.size(F.filter("lines", lambda x: x["why"] == why)).cast("long").alias(f"n_{why}")
    measured = judged.select(
        "doc_id",
        F.array_join(F.transform(F.filter("lines", lambda x: x["why"].isNull()), lambda x: x["line"]), "\n").alias("text"),
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("with_word") - F.size(F.array_distinct("with_word"))).cast("long").alias("n_dup_lines"),
        _covered(F.col("places")).alias("n_repeat_words"),
        removed("punctuation"),
        removed("navigation"),
        removed("boilerplate"),
        total(F.transform(failing, lambda x: line_chars(x["line"]).cast("long"))).alias("lost_chars"),
    )
    repeated = _share_over(F.col("n_repeat_words"), F.col("n_words"), MOST_REPEATED)
    failed = measured.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | repeated)
    lost = _share_over(F.col("lost_chars"), F.col("word_chars"), most_lost)
    return failed.withColumn("kept", ~F.col("base_failed") & ~lost)
