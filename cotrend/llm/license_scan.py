"""License scans: ordered signature rules with a keyword prefilter and containment suppression.

Built-in functions only. Anchors are derived from the rules: all spellings of a rule are written out, and each holds one of the
rule's anchors. A text passes the prefilter when it holds an anchor as a part of a word. Its words are then searched for anchor
words; around each anchor a window of words is cut out, which reaches as far as the longest spelling, and windows that meet
become one. So every place of a rule lies in exactly one window, and all places of a rule in a window are found, at once and from
left to right, by the rules of the anchors in it. A rule is a regular expression over words joined by one space; what it matches is an interval of words with the rule's priority.
Of overlapping detections those go that lie inside one of equal or higher priority (of equal intervals of equal priority
the first rule stays).

Apart from the rules, base phrases are counted at every place where their words stand consecutively.

Only windows around anchors are joined and only places are shuffled; texts never move. The rule table is fixed and broadcast.

Cases: a null text counts as empty; an empty text has no words, places or labels and score 0; equal rows are scanned one by
one, also with one doc_id; a text of any length is scanned whole; an empty table gives an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cotrend.llm.common import ASCII_UPPER, stored

#: Digits, ASCII letters and everything beyond ASCII, over lower-cased text.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same over text whose capitals are still there.
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Phrases of the base scan and their labels.
BASE = {
    ("mit", "license"): "mit",
    ("apache", "license"): "apache",
    ("general", "public", "license"): "gpl",
}

L = "(?:license|licence)"


def numbers(version: str) -> str:
    """A version as it reads once split into words; a final 0 may be missing."""
    parts = version.split(".")
    tail = "".join(f" {p}" for p in parts[1:])
    return parts[0] + (f"(?:{tail})?" if tail == " 0" else tail)


def family(label: str, name: str, versions: str, joiner: str = "(?: version| v)? ?v?") -> list[tuple[str, str, str]]:
    """One license per version: label, the name as words, the SPDX identifier as words."""
    out = []
    for version in versions.split():
        spdx = f"{label.replace('-', ' ')} {version.replace('.', ' ')}"
        out.append((f"{label}-{version}", f"{name}{joiner}{numbers(version)}", spdx))
    return out


def known_licenses() -> list[tuple[str, str, str]]:
    """Label, name and SPDX identifier, both as words."""
    gnu = "(?:gnu )?"
    out = [
        ("mit", rf"(?:mit|expat) {L}", "mit"),
        ("isc", rf"isc {L}", "isc"),
        ("zlib", rf"zlib(?: libpng)? {L}", "zlib"),
        ("unlicense", "(?:the )?unlicense", "unlicense"),
        ("wtfpl", rf"(?:wtfpl|do what the fuck you want to public {L})", "wtfpl"),
        ("bsd-2-clause", rf"(?:2 clause|simplified|freebsd) bsd(?: {L})?|bsd 2 clause(?: {L})?", "bsd 2 clause"),
        ("bsd-3-clause", rf"(?:3 clause|new|modified|revised) bsd(?: {L})?|bsd 3 clause(?: {L})?", "bsd 3 clause"),
        ("bsd-4-clause", rf"(?:4 clause|original) bsd(?: {L})?|bsd 4 clause(?: {L})?", "bsd 4 clause"),
        ("bsd", rf"bsd {L}", "0bsd"),
        ("psf-2.0", rf"(?:python software foundation|psf) {L}", "psf 2 0"),
        ("ruby", rf"ruby {L}", "ruby"),
        ("php-3.01", rf"php {L}", "php 3 01"),
        ("ncsa", rf"(?:university of illinois ncsa open source|ncsa) {L}", "ncsa"),
        ("postgresql", rf"postgresql {L}", "postgresql"),
        ("openssl", rf"openssl {L}", "openssl"),
        ("curl", rf"curl {L}", "curl"),
        ("apache", rf"apache(?: software)? {L}", "apache"),
        ("gpl", rf"{gnu}general public {L}|gnu gpl", "gpl"),
        ("lgpl", rf"{gnu}(?:lesser|library) general public {L}|gnu lgpl", "lgpl"),
        ("agpl", rf"{gnu}affero general public {L}|gnu agpl", "agpl"),
        ("cc0-1.0", r"cc0(?: 1(?: 0)?)?|creative commons zero", "cc0 1 0"),
        ("public-domain", "(?:in|into|to) the public domain|public domain", "public domain"),
        ("proprietary", "all rights reserved|end user license agreement|eula", "licenseref proprietary"),
    ]
    out += family("apache", rf"apache(?: software)? {L}", "1.0 1.1 2.0")
    out += family("gpl", rf"{gnu}(?:general public {L}|gpl)", "1.0 2.0 3.0")
    out += family("lgpl", rf"{gnu}(?:(?:lesser|library) general public {L}|lgpl)", "2.0 2.1 3.0")
    out += family("agpl", rf"{gnu}(?:affero general public {L}|agpl)", "1.0 3.0")
    out += family("mpl", rf"(?:mozilla public {L}|mpl)", "1.0 1.1 2.0")
    out += family("epl", rf"(?:eclipse public {L}|epl)", "1.0 2.0")
    out += family("cddl", rf"(?:common development and distribution {L}|cddl)", "1.0 1.1")
    out += family("eupl", rf"(?:european union public {L}|eupl)", "1.0 1.1 1.2")
    out += family("afl", rf"(?:academic free {L}|afl)", "1.1 2.0 2.1 3.0")
    out += family("osl", rf"(?:open software {L}|osl)", "1.0 2.0 2.1 3.0")
    out += family("artistic", rf"artistic {L}", "1.0 2.0")
    out += family("bsl", rf"(?:boost software {L}|bsl)", "1.0")
    out += family("zpl", rf"zope public {L}", "1.1 2.0 2.1")
    out += family("lppl", rf"(?:latex project public {L}|lppl)", "1.0 1.1 1.2 1.3")
    out += family("gfdl", rf"(?:{gnu}free documentation {L}|gfdl)", "1.1 1.2 1.3")
    out += family("ofl", rf"(?:sil )?(?:open font {L}|ofl)", "1.0 1.1")
    for terms in ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd"):
        long = {"by": "attribution", "sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s"}
        spelled = " ".join(long[t] for t in terms.split())
        name = rf"(?:cc {terms}|creative commons {spelled})(?: (?:international|unported|{L}))?"
        out += family(f"cc-{terms.replace(' ', '-')}", name, "1.0 2.0 2.5 3.0 4.0", "(?: version)? ")
    return out


#: Form, priority and score; the name takes the place of NAME, the identifier that of SPDX.
FORMS = (
    ("spdx {l} identifier SPDX", 4, 0.99),
    ("(?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?NAME", 3, 0.95),
    ("(?:subject to|governed by|under|terms of) (?:the )?(?:terms (?:and conditions )?of (?:the )?)?NAME", 2, 0.8),
    ("NAME", 1, 0.6),
)


def rules() -> list[tuple[int, str, str, int, float]]:
    """Place in the order, label, expression, priority, score: every form of every license."""
    out = []
    for form, priority, score in FORMS:
        for label, name, spdx in known_licenses():
            body = form.replace("{l}", L).replace("NAME", f"(?:{name})").replace("SPDX", spdx)
            out.append((len(out), label, rf"(?<![^ ])(?:{body})(?![^ ])", priority, score))
    return out


def spellings(expression: str) -> set[str]:
    """All texts that an expression of literals, ``(?:a|b)`` and ``?`` matches."""
    if set(expression) & set("\\[]{}*+.^$"):
        raise ValueError(f"not a finite expression: {expression}")

    def either(at: int) -> tuple[set[str], int]:
        found, at = sequence(at)
        while expression[at : at + 1] == "|":
            more, at = sequence(at + 1)
            found |= more
        return found, at

    def sequence(at: int) -> tuple[set[str], int]:
        texts = {""}
        while at < len(expression) and expression[at] not in "|)":
            part = {expression[at]}
            if expression.startswith("(?:", at):
                part, at = either(at + 3)
            at += 1
            if expression[at : at + 1] == "?":
                part, at = part | {""}, at + 1
            texts = {t + p for t in texts for p in part}
        return texts, at

    return either(0)[0]


#: Words that ordinary texts hold as well; anchors only where a spelling has no other word.
COMMON = set("gnu general public creative attribution all reserved by sa nc nd version v clause zero sil".split())


def required_words(expression: str) -> list[str]:
    """Few words, rare ones if possible, of which every spelling of the expression holds one."""
    rank = lambda w: 2 if w.startswith(("license", "licence")) else int(w not in COMMON and not w.isdigit())
    left, out = [set(t.split()) for t in spellings(expression)], []
    while left:
        hits: dict[str, int] = {}
        for words in left:
            for word in words:
                hits[word] = hits.get(word, 0) + 1
        out.append(max(hits, key=lambda w: (rank(w), hits[w], w)))
        left = [words for words in left if out[-1] not in words]
    return out


def anchors_of_rules() -> list[list[str]]:
    """The anchors of every rule, in the order of ``rules()``: those of its name, or the first word of an identifier's form."""
    names = [required_words(name) for _, name, _ in known_licenses()]
    return [["spdx"] if "SPDX" in form else own for form, _, _ in FORMS for own in names]


def longest(expression: str) -> int:
    return max(len(t.split()) for t in spellings(expression))


RULE_ANCHORS = anchors_of_rules()
ANCHORS = sorted({a for own in RULE_ANCHORS for a in own})
#: A text without any of these holds no anchor: anchors that contain no other.
STEMS = tuple(a for a in ANCHORS if not any(b != a and b in a for b in ANCHORS))
#: Words before and after an anchor; no rule spans more.
REACH = max(
    longest(form.replace("{l}", L)) - 1 + max(longest(spdx if "SPDX" in form else name) for _, name, spdx in known_licenses())
    for form, _, _ in FORMS
) - 1


#: Signs put around matches; no word holds them.
OPENS, CLOSES = "<", ">"


def rules_by_anchor(spark: SparkSession) -> DataFrame:
    """``anchor`` with its rules, and the anchors ``before`` it in the rule's list; a fixed table of some thousand rows."""
    rows = [(anchor, own[:k], *rule) for own, rule in zip(RULE_ANCHORS, rules()) for k, anchor in enumerate(own)]
    schema = "anchor string, before array<string>, rule int, label string, expression string, priority int, worth double"
    return spark.createDataFrame(rows, schema)


def lowered(text: Column) -> Column:
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def phrase_places(words: Column, n: Column, phrase: tuple[str, ...]) -> Column:
    """Where the words of a phrase stand consecutively."""
    here = lambda i: reduce(lambda a, b: a & b, [F.get(words, i + k) == w for k, w in enumerate(phrase)])
    last = n - len(phrase)
    return F.when(last >= 0, F.filter(F.sequence(F.lit(0), last), here)).otherwise(F.array().cast("array<int>"))


def find_windows(docs: DataFrame) -> DataFrame:
    """One row per document: word count, base places, and the windows around anchors, which do not meet."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    passed = reduce(lambda a, b: a | b, [F.contains(F.lower("text"), F.lit(s)) for s in STEMS])
    counted = rows.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.regexp_count("text", F.lit(ANY_CASE_WORD)).alias("n_words"),
        F.when(passed, F.regexp_extract_all(lowered(F.col("text")), F.lit(WORD), F.lit(0))).alias("words"),
    )
    words, n = F.col("words"), F.col("n_words")
    is_anchor = lambda i: F.get(words, i).isin(ANCHORS)
    marked = counted.withColumn("anchors", F.filter(F.sequence(F.lit(0), n - 1), is_anchor))
    anchors = F.col("anchors")
    # an anchor whose window does not meet that of the one before begins a window; likewise ends
    begins = F.filter(anchors, lambda a, k: (k == 0) | (a - F.get(anchors, k - 1) > 2 * REACH + 1))
    ends = F.filter(anchors, lambda a, k: (k == F.size(anchors) - 1) | (F.get(anchors, k + 1) - a > 2 * REACH + 1))
    first = lambda i: F.greatest(i - REACH, F.lit(0))
    cut = lambda i, j: F.slice(words, first(i) + 1, j + REACH + 1 - first(i))
    window = lambda i, j: F.struct(
        F.array_intersect(cut(i, j), F.array(*map(F.lit, ANCHORS))).alias("anchors"),
        first(i).alias("start"),
        F.array_join(cut(i, j), " ").alias("body"),
    )
    usable = words.isNotNull() & (n > 0)
    places = {label: F.when(usable, phrase_places(words, n, p)) for p, label in BASE.items()}
    return marked.select(
        "row",
        "doc_id",
        n.cast("long").alias("n_words"),
        *[c.alias(f"at_{label}") for label, c in places.items()],
        F.when(usable, F.zip_with(begins, ends, window)).alias("windows"),
    )


def detect(windows: DataFrame) -> DataFrame:
    """``row``, ``rule``, ``label``, ``priority``, ``worth``, ``start``, ``end`` (exclusive) of what rules match."""
    cut = windows.where(F.size("windows") > 0).select("row", F.explode("windows").alias("w")).select("row", "w.*")
    each = cut.withColumn("anchor", F.explode("anchors"))
    met = each.join(F.broadcast(rules_by_anchor(windows.sparkSession)), "anchor")
    met = met.where(~F.arrays_overlap("anchors", "before"))  # once per window and rule
    matched = met.withColumn("matched", F.expr(rf"regexp_replace(body, expression, '{OPENS}$0{CLOSES}')"))
    words = F.split("matched", " ")
    at = lambda test: F.filter(
        F.transform(words, lambda w, i: F.when(test(w), i)), lambda i: i.isNotNull()
    )
    opens, closes = at(lambda w: F.startswith(w, F.lit(OPENS))), at(lambda w: F.endswith(w, F.lit(CLOSES)))
    places = F.zip_with(opens, closes, lambda i, j: F.struct(i.alias("i"), j.alias("j")))
    found = matched.where(F.contains("matched", F.lit(OPENS))).withColumn("place", F.explode(places))
    start, end = F.col("start") + F.col("place.i"), F.col("start") + F.col("place.j") + 1
    return found.select("row", "rule", "label", "priority", "worth", start.alias("start"), end.alias("end"))


def suppress(found: DataFrame) -> DataFrame:
    """Detections that lie in no other of equal or higher priority."""
    before = (
        Window.partitionBy("row")
        .orderBy("start", F.desc("end"), F.desc("priority"), "rule")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    levels = sorted({priority for _, priority, _ in FORMS})
    reach = [F.max(F.when(F.col("priority") >= p, F.col("end"))).over(before).alias(f"reach_{p}") for p in levels]
    marked = found.select("*", *reach)
    inside = reduce(
        lambda a, b: a | b, [(F.col("priority") == p) & F.coalesce(F.col(f"reach_{p}") >= F.col("end"), F.lit(False)) for p in levels]
    )
    return marked.where(~inside).select(found.columns)


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, base places by label, ``detections``, ``labels``, ``score``.

    ``labels`` holds base and detected labels; the score is that of the best detection, 0.5 for base phrases alone.
    """
    windows = stored(find_windows(docs), "license-windows")
    kept = suppress(detect(windows))
    spans = kept.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "rule", "label", "priority"))).alias("detections"),
        F.collect_set("label").alias("found"),
        F.max("worth").alias("best"),
    )
    base = {label: F.coalesce(f"at_{label}", F.array().cast("array<int>")) for label in BASE.values()}
    named = [F.when(F.size(c) > 0, F.array(F.lit(label))).otherwise(F.array().cast("array<string>")) for label, c in base.items()]
    base_labels = F.array_sort(F.concat(*named))
    labels = F.array_sort(F.array_union(base_labels, F.coalesce("found", F.array().cast("array<string>"))))
    by_base = F.when(F.size(base_labels) > 0, F.lit(0.5)).otherwise(F.lit(0.0))
    return windows.drop("windows").join(spans, "row", "left").select(
        "doc_id",
        "n_words",
        F.concat(*base.values()).alias("base_places"),
        base_labels.alias("base_labels"),
        "detections",
        labels.alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), by_base).alias("score"),
    )
