"""Usage and co-usage trends of catalogued items, as Spark jobs."""

from cotrend.functions.keys import (
    entity_id_from_path,
    pair_key,
    path_parts,
    series_label,
)
from cotrend.functions.lines import clean_line, imported_names
from cotrend.functions.months import json_text, month_of, month_text, with_month
from cotrend.operators.baskets import (
    baskets,
    distinct_items,
    keep_catalogued,
    pairs_by_array,
    pairs_by_join,
    with_pairs,
)
from cotrend.operators.catalogue import (
    default_catalogue,
    distinct_categories,
    distinct_tools,
    default_partner_category,
    first_k_per_category,
    key_universe,
    partner_categories,
    tools_of_category,
)
from cotrend.operators.counts import (
    count_monthly,
    counts_as_text,
    drop_report,
    drop_undated,
    keys_present,
    monthly_usage,
    usage_of_baskets,
)
from cotrend.operators.extract import extract_imports
from cotrend.operators.relation import date_entities, join_relation
from cotrend.operators.trends import trend, trend_by_category, trend_pairs_by_category
from cotrend.plans.batch import count_batch, notebook_drop_report, notebook_usage, run_batch, run_batches, run_new_files
from cotrend.session import build_session, scratch_path
from cotrend.sinks.buckets import append_buckets
from cotrend.sinks.database import append_table, append_table_per_key
from cotrend.sinks.increments import (
    append_by_key,
    compact_increments,
    remove_unpublished,
    write_increment,
    write_increments,
)
from cotrend.sources.buckets import read_buckets
from cotrend.sources.catalogue_file import load_catalogue
from cotrend.sources.database import read_table, read_trend, table_exists
from cotrend.sources.files import (
    list_files,
    preview,
    read_relation,
    read_repo_metadata,
    refuse_hidden,
    scan_lines,
    urls_to_frame,
)
from cotrend.sources.increments import read_counts, read_increments, read_report
from cotrend.sources.metadata import read_metadata, write_metadata
from cotrend.sources.packed import pack_lines, read_ledger, read_packed
from cotrend.sources.records import read_records

__all__ = [
    "append_buckets",
    "append_by_key",
    "append_table",
    "append_table_per_key",
    "baskets",
    "build_session",
    "clean_line",
    "compact_increments",
    "count_batch",
    "count_monthly",
    "counts_as_text",
    "date_entities",
    "default_catalogue",
    "default_partner_category",
    "distinct_categories",
    "distinct_items",
    "distinct_tools",
    "drop_report",
    "drop_undated",
    "entity_id_from_path",
    "extract_imports",
    "first_k_per_category",
    "imported_names",
    "join_relation",
    "json_text",
    "keep_catalogued",
    "key_universe",
    "keys_present",
    "list_files",
    "load_catalogue",
    "month_of",
    "month_text",
    "monthly_usage",
    "notebook_drop_report",
    "notebook_usage",
    "pack_lines",
    "pair_key",
    "pairs_by_array",
    "pairs_by_join",
    "partner_categories",
    "path_parts",
    "preview",
    "read_buckets",
    "read_counts",
    "read_increments",
    "read_ledger",
    "read_metadata",
    "read_packed",
    "read_records",
    "read_relation",
    "read_repo_metadata",
    "read_report",
    "read_table",
    "read_trend",
    "refuse_hidden",
    "remove_unpublished",
    "run_batch",
    "run_batches",
    "run_new_files",
    "scan_lines",
    "scratch_path",
    "series_label",
    "table_exists",
    "tools_of_category",
    "trend",
    "trend_by_category",
    "trend_pairs_by_category",
    "urls_to_frame",
    "usage_of_baskets",
    "with_month",
    "with_pairs",
    "write_increment",
    "write_increments",
    "write_metadata",
]
