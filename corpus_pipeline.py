"""From raw documents to token ids: quality, line dedup, near duplicates, mixing, encoding.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept. All but the last return the columns of
``documents``. Rows are kept, dropped or repeated each on its own, also where a doc_id is null or repeated; only the lines
that documents share are counted by doc_id. What a stage returns is to be written before the next stage is called, as that
one deletes the scratch tables it reads.

Cases: null and empty texts have no words, so quality scores them like any other text, lines keep them, no row is their near
copy and the mix never takes them; very long texts are read whole; ties go to the smaller doc_id; repeated rows are near copies
of each other; an empty table passes through all stages; columns beside those of documents are left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cotrend.llm import bpe, jaccard_join, line_dedup, mixing, quality
from cotrend.llm.common import crc_remainder, delete_paths, flag_bits, noted_scratch, row_keys, stored
from cotrend.llm.queries import BPE_FILE
from cotrend.plans.tables import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_QUALITY = 0.3
LINE_DOCS = 10
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80
WEIGHTS, SHARE, LIMIT = (3, 1, 2), 1.5, 2.0


_left: dict[str, list[str]] = {}


def stage(function: Stage) -> Stage:
    """A stage that deletes the scratch tables of the stage before it, whose result is written when this one is called."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        delete_paths(spark, _left.pop(application, []))
        with noted_scratch() as paths:
            result = function(spark, docs, sf_dir)
        _left[application] = paths
        return result

    return run_stage


@stage
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    labels = table(spark, sf_dir, "labels").where(crc_remainder(F.col("doc_id"), 5) != 0)
    model = quality.fit(docs.select("doc_id", "text"), labels)
    return quality.keep(docs.select(*COLUMNS), model, LEAST_QUALITY)


@stage
def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more share go; ``n_chars`` follows the text."""
    kept = line_dedup.drop_repeated_lines(docs, LINE_DOCS, False, "lang", "source", "n_chars")
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", n_chars).select(*COLUMNS)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar rows one with the smallest doc_id stays, null last; rows without words all stay.

    Rows are told apart by their place in the table, so each is judged on its own, also where a doc_id is null or repeated. What
    goes is decided on keys alone; only rows that may go meet the keys of those that do, the others do not move.
    """
    keyed = row_keys(docs, *COLUMNS)
    digits = [F.lpad(F.hex(name), 16, "0") for name in ("_file", "_at")]
    named = keyed.select("doc_id", "text", F.unhex(F.concat(*digits)).alias("of_row"))
    groups = jaccard_join.similar_groups(named, SHINGLE_WORDS, SIMILAR_PERCENT, "of_row").where(F.col("component").isNotNull())
    rows = stored(groups.select("component", "doc_id", "of_row"), "rows")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "of_row")).alias("least")
    sizes = rows.groupBy("component").agg(least, F.count("*").alias("n")).where(F.col("n") > 1)
    several = sizes.select("component", F.col("least.of_row").alias("stays"))
    dropped = rows.join(several, "component").where(F.col("of_row") != F.col("stays"))
    number = lambda start: F.conv(F.substring(F.hex("of_row"), start, 16), 16, -10).cast("long")
    dropped = stored(dropped.select(number(1).alias("_file"), number(17).alias("_at")), "dropped")
    key = F.xxhash64("_file", "_at")
    flagged = flag_bits(keyed, key, dropped.select(key.alias("key")), "_goes")
    stays = flagged.where("not _goes").select(*COLUMNS)
    return stays.unionByName(flagged.where("_goes").join(dropped, ["_file", "_at"], "left_anti").select(*COLUMNS))


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them, each on its own, also where a doc_id is null or repeated."""
    keyed = row_keys(docs, *COLUMNS)
    mixed = mixing.mix(keyed, WEIGHTS, SHARE, LIMIT, key=("_file", "_at")).where(F.col("copies") > 0)
    met = keyed.join(mixed.select("_file", "_at", F.col("copies").cast("int").alias("copies")), ["_file", "_at"])
    return met.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


@stage
def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids``: token ids of every text."""
    encoded = bpe.encode(docs, BPE_FILE)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", keep_quality),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode_texts),
]

#: Trained rules, balanced draws and BPE are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next, which then takes its place."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, of_stage in STAGES:
        result = of_stage(spark, docs, sf_dir)
        with noted_scratch() as paths:
            docs = stored(result, f"stage-{name}")
        delete_paths(spark, before)
        before = paths
    return docs


QUERIES = {"pipeline": run}
SQL = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
