"""relaylens — Spark-native analytics for cross-chain and order-book order flow.

Every public operator is a pure function ``DataFrame -> DataFrame`` (or a
``Column`` builder) expressed with Spark's own joins, aggregates and
expressions, so Catalyst and AQE choose the physical plan. The most used
ones are re-exported here; the modules hold the rest.
"""

from .operators.bridge import latency_minute, map_codes
from .operators.fills import (fee_daily, fee_pct_daily, latency_daily, relayer_fees, relayer_yield,
                              token_share, volume_by)
from .operators.marks import high_water_mark, since
from .operators.orders import (align_legs, backlog, chain_analysis, distinct_ids, enrich_orders,
                               order_details, order_lookup, pair_analysis)
from .operators.shape import (dedupe_rows, expand_structs, flatten_json_column, flatten_struct,
                              pack_events, union_by_name, unpack_events)
from .operators.timeseries import gap_fill
from . import schemas
from .session import build_session, ensure_settings
from .sources.coverage import slice_coverage
from .sources.files import file_inventory, read_csv, read_csv_union, read_json_pages, select_files
from .sources.sinks import append_batched, append_table, write_batch, write_bucketed
from .sources.sql import sql_query

__version__ = "0.1.0"

__all__ = [
    "align_legs", "append_batched", "append_table", "backlog", "build_session", "chain_analysis",
    "dedupe_rows", "distinct_ids", "enrich_orders", "ensure_settings", "expand_structs", "fee_daily",
    "fee_pct_daily", "file_inventory", "flatten_json_column", "flatten_struct", "gap_fill",
    "high_water_mark", "latency_daily", "latency_minute", "map_codes", "order_details", "order_lookup",
    "pack_events", "pair_analysis", "read_csv", "read_csv_union", "read_json_pages", "relayer_fees",
    "relayer_yield", "select_files", "since", "slice_coverage", "sql_query", "token_share",
    "schemas", "union_by_name", "unpack_events", "volume_by", "write_batch", "write_bucketed",
]
