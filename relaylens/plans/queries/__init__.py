"""Registered queries by domain; importing this package registers them
(fills first: later modules reuse its oracles)."""

from . import fills, orders, events, files, streams  # noqa: F401  (order matters)
