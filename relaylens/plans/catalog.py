"""Registered queries over the driver tables and their DuckDB oracles.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLES[name]`` (SQL over
the views region, nation, customer, supplier, part, orders, lineitem,
events, ...). Every query reads whole tables, or files that Spark derives
from them. The queries live in ``plans/queries/`` by domain. Means of
non-integral values depend on summation order in both engines, so those
columns are rounded (same digits on both sides); sums of whole numbers and
extremes are exact and left alone.
"""

from . import queries  # noqa: F401  (registers every query)
from .queries.files import _land_bridge_pages, _land_order_book  # noqa: F401
from .queries.streams import _land_transfer_pages  # noqa: F401
from .registry import ORACLES, QUERIES, register  # noqa: F401
