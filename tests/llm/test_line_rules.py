import random
import re

import duckdb
from pyspark.sql import functions as F

from cotrend.llm import line_rules
from cotrend.llm.queries import QUERIES, SQL

from .conftest import WORDS, table_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    """The measures, the cleaned text and the verdict, by loops."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in (i, i + 1, i + 2)}
    seen, dup, kept, lost = set(), 0, [], 0
    for line in text.split("\n"):
        own = WORD.findall(line)
        dup += bool(own) and line in seen
        seen.add(line)
        if own and fails(line, len(own)):
            lost += sum(map(len, own))
        else:
            kept.append(line)
    chars = sum(map(len, words))
    base_failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    verdict = not base_failed and 100 * lost <= 30 * chars
    return (len(words), chars, symbols, dup, len(covered), base_failed, verdict), "\n".join(kept), lost


def fails(line, n):
    lower = line.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    holds = lambda phrases: any(
        not (m.start() and lower[m.start() - 1].isalnum()) and not lower[m.end() : m.end() + 1].isalnum()
        for m in re.finditer(f"({phrases})", lower)
    )
    separators = sum(c in "»›•·|>" for c in line)
    return (
        100 * sum(c in "#*$%&|<>" for c in line) > 30 * n
        or 100 * len(re.findall("[!?]{2,}", line)) > 20 * n
        or not any(c.isalpha() for c in line)
        or (n >= 30 and not any(c in ".!?:;…。！？" for c in line))
        or (separators >= 2 and 100 * separators > 25 * n)
        or (n <= 10 and not re.search(r"[.!?][ \t-\r]*\Z", line) and holds(line_rules.NAVIGATION))
        or (n <= 30 and holds(line_rules.BOILERPLATE))
    )


PROSE = " ".join(f"{a}{b}" for a in WORDS for b in "aeiou") + "."
TEXTS = [
    None, "", " \n\t\n", "word", "a b c", "a b c a b c", "x " * 60, "x y " * 40, PROSE, PROSE + "\n" + PROSE,
    PROSE + "\nHome | About | Contact | Login", PROSE[:400] + "\nHome » News » Today\nRead more\nCLICK HERE!!\n12 34",
    "\n".join(["Home | Menu | Search"] * 30), PROSE + "\nAll Rights Reserved. " + "We use cookies here",
    " ".join(w + "***" for w in PROSE.split()), " ".join(w.upper() + "!!" for w in PROSE.split()),
    PROSE.replace(".", ""), PROSE.replace(" ", "\n"), "ſ é ñ 。\r\n" * 30 + PROSE, "a\x0bb\x0cc\x1cd   e", "𝒳 𝒴 𝒵 " * 30,
    "homeless seahome\néhome homeé", "Home ", "x" * 100_000, PROSE * 200, "||| " * 5000,
]


def rows_of(docs):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return {r.doc_id: (tuple(r[n] for n in names), r.text, r.lost_chars) for r in line_rules.clean(docs).collect()}


def test_against_loops(documents):
    random.seed(3)
    parts = WORDS[:6] + ["\n", "\n", "|", "!!", "Home", "***", "7", ".", "read more", "privacy policy", "\t", "é"]
    texts = [t for t in TEXTS if len(t or "") < 20_000]
    texts += [" ".join(random.choice(parts) for _ in range(random.randint(0, 150))) for _ in range(150)]
    got = rows_of(documents([(i, t, "en", "a") for i, t in enumerate(texts)]))
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert got[i] == brute(text), text


def test_very_long_texts_are_measured_whole(documents):
    got = rows_of(documents([(0, "x" * 100_000, "en", "a"), (1, (PROSE + " ") * 200, "en", "a"), (2, "||| " * 50_000, "en", "a")]))
    assert got[0][0] == (1, 100_000, 0, 0, 0, True, False)
    assert got[1][0][0] == got[1][0][4] and got[1][0][5:] == (True, False)
    assert got[2][0] == (50_000, 150_000, 150_000, 0, 50_000, True, False) and got[2][1:] == ("", 150_000)


def test_nulls_repeated_rows_and_empty_table(documents, spark):
    N = len(PROSE.split())
    rows = [(None, PROSE, None, None), (1, PROSE, "en", "a"), (1, PROSE, "en", "a"), (1, "other", "en", "a")]
    got = line_rules.clean(documents(rows)).select("doc_id", "n_words", "kept")
    assert table_of(got) == sorted([(None, N, True), (1, N, True), (1, N, True), (1, 1, False)], key=repr)
    assert line_rules.clean(documents(rows[:0])).count() == 0


def test_a_stricter_limit_rejects_more(documents):
    docs = documents([(1, PROSE + "\nHome | About | Contact | Login | Search | Menu", "en", "a")])
    assert [r.kept for r in line_rules.clean(docs).collect()] == [True]
    assert [r.kept for r in line_rules.clean(docs, most_lost=1).collect()] == [False]


def test_the_plan_moves_no_text(documents):
    plan = line_rules.clean(documents([(1, PROSE, "en", "a")], clash=False).coalesce(1))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "Python" not in physical and "Arrow" not in physical and physical.count("Exchange") <= 1  # the fixture's own


def test_query_against_sql_on_odd_texts(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, PROSE), (3, PROSE)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.withColumn("lang", F.lit("en")).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    ours = QUERIES["op11_line_rules"](spark, str(tmp_path))
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        theirs = db.sql(SQL["op11_line_rules"]).fetchall()
    assert table_of(ours) == sorted(theirs, key=repr)
