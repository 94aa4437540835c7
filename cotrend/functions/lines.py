"""Import statements in notebook text lines.

A notebook is scanned as plain lines; a source line looks like ``    "import numpy as np\\n",`` with
a backslash and a letter for the line end. The rules below keep the behaviour users rely on, quirks
included (a last line without ``\\n`` loses a final ``n``; indented imports are missed).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Results depend on these characters and on their order.
BLANKS = " \t\n\r\x0b\x0c"
STRIPPED_IN_TURN = (BLANKS, ",", '"', "n", "\\")
CUT_AT_FIRST = ("#", " as ")


def clean_line(line: Column) -> Column:
    """Statement text of a line: ends stripped in turn, then cut at a comment and at an alias."""
    for chars in STRIPPED_IN_TURN:
        line = F.btrim(line, F.lit(chars))
    for mark in CUT_AT_FIRST:
        line = F.substring_index(line, mark, 1)
    return line


def may_import(line: Column) -> Column:
    """True for every line that can yield a name: both statement forms hold the word ``import``."""
    return F.contains(line, F.lit("import"))


def words(line: Column) -> Column:
    return F.split(clean_line(line), " ", -1)


def _top_package(name: Column) -> Column:
    return F.substring_index(name, ".", 1)


def names_in_words(tokens: Column) -> Column:
    """Names of one statement, given its words; NULL when it is no import statement."""
    listed = F.transform(
        F.slice(tokens, F.lit(2), F.size(tokens)),
        lambda word: _top_package(F.btrim(word, F.lit(", "))),
    )
    first, second, third = (F.get(tokens, F.lit(i)) for i in range(3))
    return F.when(first == "import", listed).when(
        (first == "from") & (third == "import"), F.array(_top_package(second))
    )


def imported_names(line: Column) -> Column:
    """Names imported by one line, as an array; NULL when it imports nothing."""
    return names_in_words(words(line))
