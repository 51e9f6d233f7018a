"""Bindings to the driver tables, multi-step flows and the query catalog."""
