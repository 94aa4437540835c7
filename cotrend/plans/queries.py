"""One query per operator on the driver's tables, each with SQL that gives the same result."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cotrend.functions.keys import entity_id_from_path, path_parts
from cotrend.functions.months import json_text, month_text, with_month
from cotrend.operators import baskets as bk
from cotrend.operators import catalogue as cat
from cotrend.operators import counts as ct
from cotrend.operators import trends as tr
from cotrend.operators.extract import extract_imports
from cotrend.operators.relation import date_entities, join_relation
from cotrend.plans import tables as tb
from cotrend.plans.batch import count_batch, notebook_drop_report, notebook_usage
from cotrend.session import scratch_path
from cotrend.sinks.buckets import append_buckets
from cotrend.sinks.increments import append_by_key, compact_increments, write_increment, write_increments
from cotrend.sources import files
from cotrend.sources.buckets import read_buckets
from cotrend.sources.catalogue_file import load_catalogue
from cotrend.sources.increments import read_counts, read_increments, read_report
from cotrend.sources.metadata import read_metadata, write_metadata
from cotrend.sources.packed import pack_lines, read_packed
from cotrend.sources.records import read_records

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

USED = """used AS (
  SELECT DISTINCT l_orderkey AS entity, n_name AS item
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)"""
DATED = """dated AS (
  SELECT o_orderkey AS entity, strftime(o_orderdate, '%Y-%m') AS datetime FROM orders)"""
PAIRED = """paired AS (
  SELECT a.entity, a.item AS item_a, b.item AS item_b
  FROM used a JOIN used b ON a.entity = b.entity AND a.item < b.item)"""
SINGLE_COUNTS = """single_counts AS (
  SELECT item AS library, item AS item_a, '' AS item_b, datetime, count(*) AS lib_counts
  FROM used JOIN dated USING (entity) GROUP BY item, datetime)"""
PAIR_COUNTS = """pair_counts AS (
  SELECT item_a || '_' || item_b AS library, item_a, item_b, datetime, count(*) AS lib_counts
  FROM paired JOIN dated USING (entity) GROUP BY item_a, item_b, datetime)"""
COUNTS = """counts AS (
  SELECT * FROM single_counts UNION ALL SELECT * FROM pair_counts)"""
TOOLS = """tools AS (
  SELECT n_name AS "Libraries", r_name AS "Category", n_nationkey AS pos
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""
SUPPLIER_TOOLS = """tools AS (
  SELECT s_name AS "Libraries", n_name AS "Category", CAST(s_suppkey AS INTEGER) AS pos
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""
PARTLY_DATED = """partly AS (
  SELECT o_orderkey AS entity,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m') END AS datetime
  FROM orders)"""

CHOSEN_TOOL = "NATION_0"
CHOSEN_CATEGORY = "ASIA"
CHOSEN_PAIR = ("NATION_0", "NATION_1")


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


SINGLES_WITH = with_(USED, DATED, SINGLE_COUNTS)
PAIRS_WITH = with_(USED, DATED, PAIRED, PAIR_COUNTS)
ALL_WITH = with_(USED, DATED, PAIRED, SINGLE_COUNTS, PAIR_COUNTS, COUNTS)


def query(sql: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        name = function.__name__.strip("_")
        QUERIES[name] = function
        SQL[name] = sql
        return function

    return register


def _usage(spark: SparkSession, sf_dir: str, singles: bool = True, pairs: bool = True) -> DataFrame:
    return ct.monthly_usage(
        tb.items(spark, sf_dir),
        tb.entities(spark, sf_dir),
        tb.catalogue(spark, sf_dir),
        one_row_per_entity=True,
        singles=singles,
        pairs=pairs,
    )


def _stored_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All counts, written as one increment and read again."""
    root = scratch_path(spark, "counts")
    write_increment(_usage(spark, sf_dir), root, "all")
    return read_increments(spark, root)


def _plain(counts: DataFrame) -> DataFrame:
    """Counts with '' for "no second item"."""
    return counts.withColumn("item_b", F.coalesce("item_b", F.lit("")))


#: Two batches named like the folders they could come from.
FINISHED, OPEN = "orders/finished/", "orders/open 100%"


def _batches(spark: SparkSession, sf_dir: str, pairs: bool) -> DataFrame:
    """Counts of the whole of the orders in two batches whose months overlap, from one pass over the items."""
    finished = F.coalesce(F.col("status") == "F", F.lit(False))
    batch_id = F.when(finished, FINISHED).otherwise(OPEN)
    return ct.monthly_usage(
        tb.items(spark, sf_dir),
        tb.entities(spark, sf_dir).withColumn("batch_id", batch_id),
        tb.catalogue(spark, sf_dir),
        one_row_per_entity=True,
        pairs=pairs,
        more=("batch_id",),
    )


# --- whole jobs ---------------------------------------------------------------------------------


@query(ALL_WITH + "SELECT * FROM counts")
def monthly_usage(spark, sf_dir):
    return _plain(_usage(spark, sf_dir))


@query(
    with_(
        USED,
        """dated AS (
  SELECT o_orderkey AS entity, strftime(last, '%Y-%m') AS datetime
  FROM orders JOIN (SELECT o_custkey, max(o_orderdate) AS last FROM orders GROUP BY o_custkey)
  USING (o_custkey))""",
        PAIRED,
        SINGLE_COUNTS,
        PAIR_COUNTS,
        COUNTS,
    )
    + "SELECT * FROM counts"
)
def notebook_usage_(spark, sf_dir):
    metadata = tb.customer_documents(spark, sf_dir).select(
        "repo_id", json_text(F.col("document"), "updated_at").alias("updated_at")
    )
    counts = notebook_usage(
        tb.notebook_lines(spark, sf_dir),
        tb.order_relation(spark, sf_dir),
        metadata,
        tb.catalogue(spark, sf_dir),
    )
    return _plain(counts)


# --- scans --------------------------------------------------------------------------------------


def _source_folder() -> Column:
    return F.regexp_extract("path", "/(documents|conversations)-[^/]*/[^/]*$", 1)


def _write_text_files(rows: DataFrame, root: str, n_files: int) -> None:
    """``text`` of ``rows`` as ``n_files`` text files of about the same size.

    Spark writes a file in one task, so each task takes its share of the whole table. The shares are written before that,
    by all tasks of the scan and in columns that zstd compresses, and each is then read as a stream: a task reads about two
    thirds of what a shuffle would bring it, and nothing is sorted.
    """
    spark = rows.sparkSession
    dealt = scratch_path(spark, "dealt")
    share = F.pmod(F.spark_partition_id() + F.monotonically_increasing_id(), F.lit(n_files)).cast("int")
    by_share = rows.select("text", share.alias("share"))
    by_share.write.partitionBy("share").option("compression", "zstd").parquet(dealt)
    stored = spark.read.schema(by_share.schema).parquet(dealt)
    shares = [stored.where(F.col("share") == i).select("text").coalesce(1) for i in range(n_files)]
    # from Spark 4.1 on a union of single partitions is a single partition, unless told otherwise
    merges = "spark.sql.unionOutputPartitioning"
    before = spark.conf.get(merges, None)
    spark.conf.set(merges, "false")
    try:
        reduce(DataFrame.unionAll, shares).write.text(root)
    finally:
        if before is None:
            spark.conf.unset(merges)
        else:
            spark.conf.set(merges, before)


def _text_folders(spark: SparkSession, sf_dir: str, files_each: int | None = None) -> list[str]:
    """Two tables written as folders of text files; each text ends with one newline more."""
    roots = []
    for name in ("documents", "conversations"):
        roots.append(scratch_path(spark, name))
        rows = tb.table(spark, sf_dir, name).select("text")
        if files_each:
            _write_text_files(rows, roots[-1], files_each)
        else:
            rows.write.text(roots[-1])
    return roots


@query(
    """SELECT 'documents' AS folder, 4 AS files, CAST(sum(strlen(text) + 1) AS BIGINT) AS bytes FROM documents
UNION ALL
SELECT 'conversations', 4, CAST(sum(strlen(text) + 1) AS BIGINT) FROM conversations"""
)
def scan_file_listing(spark, sf_dir):
    folders = _text_folders(spark, sf_dir, files_each=4)
    listing = files.list_files(spark, [*folders, scratch_path(spark, "missing")])
    return listing.groupBy(_source_folder().alias("folder")).agg(
        F.count("*").cast("int").alias("files"), F.sum("length").alias("bytes")
    )


@query("SELECT unnest(string_split(text, chr(10))) AS line FROM conversations")
def scan_text_lines(spark, sf_dir):
    root = scratch_path(spark, "lines")
    tb.table(spark, sf_dir, "conversations").select("text").write.text(root)
    return files.scan_lines(spark, [root]).select("line")


def _documents_as_csv(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "relation")
    documents = tb.table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    documents.write.csv(
        root,
        header=True,
        quoteAll=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return root


@query(
    """SELECT 1 AS pack, unnest(string_split(text, chr(10))) AS line FROM documents
UNION ALL
SELECT 2, unnest(string_split(text, chr(10))) FROM conversations"""
)
def packed_lines(spark, sf_dir):
    """A folder that grows between two calls: the second one packs the new files only."""
    folder, store = scratch_path(spark, "growing"), scratch_path(spark, "packed")
    for name in ("documents", "conversations"):
        tb.table(spark, sf_dir, name).select("text").write.mode("append").text(folder)
        pack_lines(spark, [folder], store)
    return read_packed(spark, store).select(F.substring_index("pack", "-", 1).cast("int").alias("pack"), "line")


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang FROM documents")
def scan_csv_multiline(spark, sf_dir):
    return files.read_relation(spark, _documents_as_csv(spark, sf_dir)).select("doc_id", "text", "lang")


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source FROM documents")
def scan_csv_records(spark, sf_dir):
    return read_records(spark, _documents_as_csv(spark, sf_dir)).select("doc_id", "text", "lang", "source")


@query(
    with_(TOOLS)
    + """SELECT "Libraries", "Category", pos, count(*) AS lines
FROM tools JOIN nation ON n_name = "Libraries"
JOIN supplier ON s_nationkey = n_nationkey JOIN lineitem ON l_suppkey = s_suppkey
GROUP BY "Libraries", "Category", pos"""
)
def scan_catalogue(spark, sf_dir):
    root = scratch_path(spark, "catalogue")
    # 25 rows; a catalogue is one file, and its order counts
    tools = tb.catalogue(spark, sf_dir)
    tools.repartition(1).sortWithinPartitions("pos").select("Libraries", "Category").write.csv(root, header=True)
    catalogue = load_catalogue(spark, root)
    lines = tb.items(spark, sf_dir).groupBy("item").agg(F.count("*").alias("lines"))
    named = catalogue.join(lines, F.col("Libraries") == F.col("item"))
    return named.select("Libraries", "Category", "pos", "lines")


@query(
    """SELECT CAST(c_nationkey AS VARCHAR) AS repo_id,
       strftime(max(o_orderdate), '%Y-%m-%dT%H:%M:%SZ') AS updated_at,
       strftime(max(o_orderdate), '%Y-%m') AS datetime
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey"""
)
def scan_repo_metadata(spark, sf_dir):
    root = scratch_path(spark, "metadata")
    orders, customers = tb.table(spark, sf_dir, "orders"), tb.table(spark, sf_dir, "customer")
    last = (
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey")
        .agg(F.max("o_orderdate").alias("last"), F.count("*").alias("size"))
    )
    # a folder repo_<id>.json per nation, with one object in it
    name = F.concat(F.lit("repo_"), F.col("c_nationkey").cast("string"), F.lit(".json"))
    objects = last.select(name.alias("object"), "size", tb.iso_text(F.col("last")).alias("updated_at"))
    objects.write.partitionBy("object").json(root)
    dated = with_month(files.read_repo_metadata(spark, root), "updated_at")
    return dated.select("repo_id", "updated_at", month_text(F.col("month")).alias("datetime"))


@query(
    """SELECT source, count(*) AS lines, CAST(sum(strlen(line)) AS BIGINT) AS bytes FROM (
  SELECT 'documents' AS source, unnest(string_split(text, chr(10))) AS line FROM documents
  UNION ALL
  SELECT 'conversations', unnest(string_split(text, chr(10))) FROM conversations)
GROUP BY source"""
)
def union_sources(spark, sf_dir):
    lines = files.scan_lines(spark, _text_folders(spark, sf_dir))
    return lines.groupBy(_source_folder().alias("source")).agg(
        F.count("*").alias("lines"), F.sum(F.octet_length("line").cast("bigint")).alias("bytes")
    )


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 10")
def preview_limit(spark, sf_dir):
    orders = tb.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return files.preview(orders, "o_orderkey", 10)


# --- projections, functions, joins to months ----------------------------------------------------


@query("SELECT CAST(o_orderkey AS VARCHAR) AS nb_id, o_orderkey FROM orders")
def path_entity_id(spark, sf_dir):
    orders = tb.table(spark, sf_dir, "orders").select("o_orderkey")
    path = tb.notebook_path(F.col("o_orderkey"))
    return orders.select(entity_id_from_path(path).alias("nb_id"), "o_orderkey")


@query(
    """SELECT o_orderkey, 'bucket' AS bucket, 'notebooks_6/nb_' || o_orderkey || '.ipynb' AS key,
       'nb_' || o_orderkey || '.ipynb' AS file_name FROM orders"""
)
def path_parts_(spark, sf_dir):
    orders = tb.table(spark, sf_dir, "orders").select("o_orderkey")
    parts = path_parts(tb.notebook_path(F.col("o_orderkey")))
    return orders.select("o_orderkey", *[part.alias(name) for name, part in parts.items()])


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS nb_id,
       's3a://bucket/notebooks_6/nb_' || o_orderkey || '.ipynb' AS s3_url,
       CAST(l_suppkey AS VARCHAR) AS repo_id
FROM orders JOIN lineitem ON o_orderkey = l_orderkey"""
)
def join_entity_repo(spark, sf_dir):
    orders = tb.table(spark, sf_dir, "orders")
    urls = orders.select(tb.notebook_path(F.col("o_orderkey")).alias("s3_url"))
    relation = tb.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("nb_id"),
        F.col("l_suppkey").cast("string").alias("repo_id"),
    )
    return join_relation(urls, relation)


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS nb_id, CAST(o_custkey AS VARCHAR) AS repo_id,
       strftime(last, '%Y-%m') AS datetime
FROM orders JOIN (SELECT o_custkey, max(o_orderdate) AS last FROM orders GROUP BY o_custkey)
USING (o_custkey)"""
)
def join_metadata_month(spark, sf_dir):
    metadata = tb.customer_documents(spark, sf_dir).select(
        "repo_id", json_text(F.col("document"), "updated_at").alias("updated_at")
    )
    dated = date_entities(tb.order_relation(spark, sf_dir), metadata)
    return dated.select("nb_id", "repo_id", month_text(F.col("month")).alias("datetime"))


@query(
    """SELECT o_orderstatus AS status, CAST(o_orderkey AS VARCHAR) AS nb_id, strftime(last, '%Y-%m') AS datetime
FROM orders JOIN (SELECT o_custkey, max(o_orderdate) AS last FROM orders GROUP BY o_custkey)
USING (o_custkey)"""
)
def join_stored_metadata(spark, sf_dir):
    """Finished and other orders as two batches that look up their own repositories in a store of dates."""
    root = scratch_path(spark, "dates")
    metadata = tb.customer_documents(spark, sf_dir)
    write_metadata(metadata.select("repo_id", json_text(F.col("document"), "updated_at").alias("updated_at")), root)
    orders = tb.table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderkey").cast("string").alias("nb_id"),
        F.col("o_custkey").cast("string").alias("repo_id"),
    )
    finished = F.coalesce(F.col("status") == "F", F.lit(False))

    def dated(batch: DataFrame) -> DataFrame:
        months = date_entities(batch, read_metadata(spark, root))
        return months.join(batch.select("nb_id", "status"), "nb_id")

    both = dated(orders.where(finished)).unionByName(dated(orders.where(~finished)))
    return both.select("status", "nb_id", month_text(F.col("month")).alias("datetime"))


@query(
    with_(PARTLY_DATED)
    + "SELECT entity, coalesce(datetime, 'none') AS datetime FROM partly"
)
def month_bucket(spark, sf_dir):
    dated = with_month(tb.partly_dated_text(spark, sf_dir), "updated_at")
    return dated.select("entity", F.coalesce(month_text(F.col("month")), F.lit("none")).alias("datetime"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_field(spark, sf_dir):
    events = tb.table(spark, sf_dir, "events")
    return events.select("event_id", json_text(F.col("props"), "k").alias("k"))


@query(with_(PARTLY_DATED) + "SELECT entity, datetime FROM partly WHERE datetime IS NOT NULL")
def drop_undated(spark, sf_dir):
    dated = with_month(tb.partly_dated_text(spark, sf_dir), "updated_at")
    return ct.drop_undated(dated).select("entity", month_text(F.col("month")).alias("datetime"))


@query(
    """SELECT item, count(DISTINCT entity) AS notebooks FROM (
  SELECT l_orderkey AS entity, n_name AS item
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  UNION ALL
  SELECT l_orderkey, 'os'
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  WHERE l_returnflag NOT IN ('A', 'R'))
GROUP BY item"""
)
def extract_imports_(spark, sf_dir):
    names = extract_imports(tb.notebook_lines(spark, sf_dir))
    return names.groupBy("item").agg(F.count("*").alias("notebooks"))


# --- items, baskets, pairs ----------------------------------------------------------------------


@query(
    """SELECT l_orderkey AS entity, n_name AS item
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name IN ('ASIA', 'EUROPE'))"""
)
def semi_join_catalogue(spark, sf_dir):
    two_regions = tb.catalogue(spark, sf_dir).where(F.col("Category").isin("ASIA", "EUROPE"))
    return bk.keep_catalogued(tb.items(spark, sf_dir), two_regions)


@query(with_(USED) + "SELECT entity, item FROM used")
def distinct_items_per_entity(spark, sf_dir):
    return bk.distinct_items(tb.items(spark, sf_dir))


@query(
    with_(USED, PAIRED)
    + "SELECT entity, item_a, item_b, item_a || '_' || item_b AS library FROM paired"
)
def pair_items_array(spark, sf_dir):
    return bk.pairs_by_array(bk.baskets(tb.items(spark, sf_dir), tb.catalogue(spark, sf_dir)))


@query(
    with_(USED, PAIRED)
    + "SELECT entity, item_a, item_b, item_a || '_' || item_b AS library FROM paired"
)
def pair_items_join(spark, sf_dir):
    return bk.pairs_by_join(tb.items(spark, sf_dir), tb.catalogue(spark, sf_dir))


@query(
    with_(USED, PAIRED)
    + """SELECT library, count(*) AS lib_counts FROM (
  SELECT item AS library FROM used UNION ALL SELECT item_a || '_' || item_b FROM paired)
GROUP BY library"""
)
def count_items_and_pairs(spark, sf_dir):
    found = bk.baskets(tb.items(spark, sf_dir), tb.catalogue(spark, sf_dir))
    return ct.count_monthly(bk.with_pairs(found), keys=("library",))


@query(SINGLES_WITH + "SELECT library, datetime, lib_counts FROM single_counts")
def count_items_monthly(spark, sf_dir):
    return _usage(spark, sf_dir, pairs=False).select("library", "datetime", "lib_counts")


@query(PAIRS_WITH + "SELECT library, datetime, lib_counts FROM pair_counts")
def count_pairs_monthly(spark, sf_dir):
    return _usage(spark, sf_dir, singles=False).select("library", "datetime", "lib_counts")


@query(
    SINGLES_WITH
    + """SELECT library, datetime, CAST(lib_counts AS VARCHAR) AS lib_counts,
       CAST(lib_counts AS INTEGER) AS users FROM single_counts"""
)
def cast_counts(spark, sf_dir):
    text = ct.counts_as_text(_usage(spark, sf_dir, pairs=False))
    return text.select(
        "library", "datetime", "lib_counts", ct.count_number().cast("int").alias("users")
    )


@query(
    ALL_WITH
    + """SELECT library, item_a, item_b, count(DISTINCT datetime) AS months, CAST(sum(lib_counts) AS BIGINT) AS total
FROM counts GROUP BY library, item_a, item_b"""
)
def keys_present(spark, sf_dir):
    return _plain(ct.keys_present(_usage(spark, sf_dir)))


@query(
    with_(USED, PARTLY_DATED)
    + """SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN datetime IS NULL THEN 'no date'
              WHEN entity NOT IN (SELECT entity FROM used WHERE item IN (
                SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey
                WHERE r_name = 'ASIA')) THEN 'no catalogued item'
              ELSE 'counted' END AS reason
  FROM partly) GROUP BY reason"""
)
def drop_report(spark, sf_dir):
    entities = with_month(tb.partly_dated_text(spark, sf_dir), "updated_at")
    one_region = tb.catalogue(spark, sf_dir).where(F.col("Category") == "ASIA")
    return ct.drop_report(tb.items(spark, sf_dir), entities, one_region)


FILE_REASONS = (
    with_(USED)
    + """SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN o_orderkey IS NULL THEN 'no relation row'
              WHEN last < TIMESTAMP '1998-06-01' THEN 'no date'
              WHEN entity NOT IN (SELECT entity FROM used WHERE item IN (
                SELECT n_name FROM nation JOIN region ON n_regionkey = r_regionkey
                WHERE r_name = 'ASIA')) THEN 'no catalogued item'
              ELSE 'counted' END AS reason
  FROM (SELECT DISTINCT entity FROM used)
  LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') ON entity = o_orderkey
  LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS last FROM orders GROUP BY o_custkey) USING (o_custkey))
GROUP BY reason"""
)


def _partly_listed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    # orders of status P have no relation row; customers whose last order is old have a date of another form
    listed = tb.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P")
    relation = listed.select(
        F.col("o_orderkey").cast("string").alias("nb_id"), F.col("o_custkey").cast("string").alias("repo_id")
    )
    dated = tb.customer_documents(spark, sf_dir).select("repo_id", json_text(F.col("document"), "updated_at").alias("text"))
    text = F.when(F.col("text") < "1998-06-01", F.substring("text", 1, 10)).otherwise(F.col("text"))
    metadata = dated.select("repo_id", text.alias("updated_at"))
    one_region = tb.catalogue(spark, sf_dir).where(F.col("Category") == "ASIA")
    return tb.notebook_lines(spark, sf_dir), relation, metadata, one_region


@query(FILE_REASONS)
def notebook_drop_report_(spark, sf_dir):
    return notebook_drop_report(*_partly_listed(spark, sf_dir))


@query(FILE_REASONS.replace("SELECT reason,", "SELECT 'listed' AS batch_id, reason,", 1))
def stored_drop_report(spark, sf_dir):
    """The report that a batch stores with its counts, from the scan that counts."""
    root, (lines, *tables) = scratch_path(spark, "reported"), _partly_listed(spark, sf_dir)
    count_batch(lines, lines.select("path").distinct(), *tables, root, "listed")
    return read_report(spark, root)


# --- catalogue ----------------------------------------------------------------------------------


@query(with_(SUPPLIER_TOOLS) + """SELECT "Libraries", pos FROM tools WHERE "Category" = 'NATION_3'""")
def catalogue_by_category(spark, sf_dir):
    return cat.tools_of_category(tb.supplier_catalogue(spark, sf_dir), "NATION_3")


@query(
    with_(SUPPLIER_TOOLS)
    + """SELECT "Category", min(pos) AS pos,
       min(pos) = (SELECT min(pos) FROM tools WHERE "Category" <> (
         SELECT "Category" FROM tools WHERE "Libraries" = (
           SELECT "Libraries" FROM tools ORDER BY pos LIMIT 1))) AS is_default
FROM tools WHERE "Category" <> (
  SELECT "Category" FROM tools WHERE "Libraries" = (SELECT "Libraries" FROM tools ORDER BY pos LIMIT 1))
GROUP BY "Category\""""
)
def catalogue_other_categories(spark, sf_dir):
    tools = tb.supplier_catalogue(spark, sf_dir)
    return cat.partner_categories(tools, _first_tool(tools))


@query(
    with_(SUPPLIER_TOOLS)
    + """SELECT "Category", min(pos) AS pos FROM tools WHERE "Category" <> (
  SELECT "Category" FROM tools WHERE "Libraries" = (SELECT "Libraries" FROM tools ORDER BY pos LIMIT 1))
GROUP BY "Category" ORDER BY pos LIMIT 1"""
)
def catalogue_default_partner(spark, sf_dir):
    tools = tb.supplier_catalogue(spark, sf_dir)
    return cat.default_partner_category(tools, _first_tool(tools))


def _first_tool(tools: DataFrame) -> str:
    return files.preview(tools.select("Libraries", "pos"), "pos", 1).first().Libraries


@query(with_(SUPPLIER_TOOLS) + """SELECT "Category", min(pos) AS pos FROM tools GROUP BY "Category\"""")
def catalogue_distinct(spark, sf_dir):
    return cat.distinct_categories(tb.supplier_catalogue(spark, sf_dir))


@query(with_(SUPPLIER_TOOLS) + """SELECT "Libraries", min(pos) AS pos FROM tools GROUP BY "Libraries\"""")
def catalogue_distinct_tools(spark, sf_dir):
    return cat.distinct_tools(tb.supplier_catalogue(spark, sf_dir))


@query(
    with_(SUPPLIER_TOOLS)
    + """SELECT * FROM (SELECT "Libraries", "Category", pos,
       CAST(row_number() OVER (PARTITION BY "Category" ORDER BY pos) AS INTEGER) AS rank FROM tools)
WHERE rank <= 3"""
)
def catalogue_first_k(spark, sf_dir):
    return cat.first_k_per_category(tb.supplier_catalogue(spark, sf_dir), k=3)


@query(
    with_(USED, DATED, PAIRED, SINGLE_COUNTS, PAIR_COUNTS, COUNTS, TOOLS)
    + """SELECT library, item_a, item_b, CAST(coalesce(total, 0) AS BIGINT) AS total FROM (
  SELECT "Libraries" AS library, "Libraries" AS item_a, '' AS item_b FROM tools
  UNION ALL
  SELECT a."Libraries" || '_' || b."Libraries", a."Libraries", b."Libraries"
  FROM tools a JOIN tools b ON a."Libraries" < b."Libraries")
LEFT JOIN (SELECT item_a, item_b, sum(lib_counts) AS total FROM counts GROUP BY item_a, item_b)
USING (item_a, item_b)"""
)
def key_universe(spark, sf_dir):
    present = _plain(ct.keys_present(_usage(spark, sf_dir))).select("item_a", "item_b", "total")
    keys = _plain(cat.key_universe(tb.catalogue(spark, sf_dir)))
    total = F.coalesce("total", F.lit(0).cast("bigint")).alias("total")
    return keys.join(present, ["item_a", "item_b"], "left").select("library", "item_a", "item_b", total)


# --- trends, over a stored table ----------------------------------------------------------------


@query(
    PAIRS_WITH
    + f"""SELECT datetime, CAST(sum(lib_counts) AS BIGINT) AS users FROM pair_counts
WHERE item_a = '{CHOSEN_PAIR[0]}' AND item_b = '{CHOSEN_PAIR[1]}' GROUP BY datetime ORDER BY datetime"""
)
def trend_one_key(spark, sf_dir):
    return tr.trend(_stored_usage(spark, sf_dir), *CHOSEN_PAIR)


@query(
    with_(USED, DATED, SINGLE_COUNTS, TOOLS)
    + f"""SELECT library AS series, datetime, CAST(sum(lib_counts) AS BIGINT) AS users
FROM single_counts JOIN (
  SELECT "Libraries" AS library FROM tools WHERE "Category" = '{CHOSEN_CATEGORY}') USING (library)
GROUP BY library, datetime"""
)
def trend_by_category(spark, sf_dir):
    counts = _stored_usage(spark, sf_dir)
    return tr.trend_by_category(counts, tb.catalogue(spark, sf_dir), CHOSEN_CATEGORY)


@query(
    with_(USED, DATED, PAIRED, PAIR_COUNTS, TOOLS)
    + f"""SELECT series, datetime, CAST(sum(lib_counts) AS BIGINT) AS users
FROM pair_counts JOIN (
  SELECT '{CHOSEN_TOOL} + ' || "Libraries" AS series,
         least("Libraries", '{CHOSEN_TOOL}') || '_' || greatest("Libraries", '{CHOSEN_TOOL}') AS library
  FROM tools WHERE "Category" = '{CHOSEN_CATEGORY}') USING (library)
GROUP BY series, datetime"""
)
def trend_pairs_by_category(spark, sf_dir):
    counts = _stored_usage(spark, sf_dir)
    tools = tb.catalogue(spark, sf_dir)
    return tr.trend_pairs_by_category(counts, tools, CHOSEN_TOOL, CHOSEN_CATEGORY)


# --- sinks: write, then return what is read back ------------------------------------------------


@query(SINGLES_WITH + "SELECT library, datetime, lib_counts AS users FROM single_counts")
def sink_append_roundtrip(spark, sf_dir):
    root = scratch_path(spark, "appended")
    append_by_key(_batches(spark, sf_dir, pairs=False), root)
    stored = read_increments(spark, root)
    return stored.groupBy("library", "datetime").agg(F.sum("lib_counts").alias("users"))


@query(ALL_WITH + "SELECT library, item_a, item_b, datetime, lib_counts FROM counts")
def sink_fanout_by_key(spark, sf_dir):
    root = scratch_path(spark, "by-key")
    append_buckets(_usage(spark, sf_dir), root)
    return _plain(read_buckets(spark, root)).select("library", "item_a", "item_b", "datetime", "lib_counts")


@query(
    ALL_WITH
    + f"""SELECT library, item_a, item_b, datetime, lib_counts AS users,
       '{FINISHED};{OPEN}' AS batches FROM counts"""
)
def increments_sum(spark, sf_dir):
    root = scratch_path(spark, "increments")
    counts = _batches(spark, sf_dir, pairs=True)
    write_increments(counts, root, [FINISHED, OPEN])
    stored = _plain(read_increments(spark, root))
    ids = stored.agg(F.array_join(F.array_sort(F.collect_set("batch_id")), ";"))
    summed = stored.groupBy("library", "item_a", "item_b", "datetime").agg(F.sum("lib_counts").alias("users"))
    return summed.withColumn("batches", ids.scalar())


@query(ALL_WITH + f"SELECT library, item_a, item_b, datetime, lib_counts, '{FINISHED}' AS batch_id FROM counts")
def published_batches(spark, sf_dir):
    """A batch of all orders takes the place of its first run, of single tools; one that ran before is cleared."""
    root = scratch_path(spark, "published")
    first = _usage(spark, sf_dir, pairs=False)
    write_increment(first, root, FINISHED)
    write_increment(first, root, OPEN)
    write_increments(_usage(spark, sf_dir).withColumn("batch_id", F.lit(FINISHED)), root, [FINISHED, OPEN])
    return _plain(read_increments(spark, root))


@query(ALL_WITH + "SELECT library, item_a, item_b, datetime, lib_counts FROM counts")
def increments_compacted(spark, sf_dir):
    """Two batches, the first compacted alone and run again afterwards, add up to the counts of all orders."""
    root = scratch_path(spark, "compacted")
    counts = _batches(spark, sf_dir, pairs=True)
    first = F.col("batch_id") == FINISHED
    write_increment(counts.where(first & F.col("item_b").isNull()), root, FINISHED)
    compact_increments(spark, root)
    write_increments(counts, root, [FINISHED, OPEN])
    return _plain(read_counts(spark, root))
