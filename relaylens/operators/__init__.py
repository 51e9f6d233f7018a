"""DataFrame -> DataFrame operators."""

from . import bridge, fills, marks, orders, shape, timeseries  # noqa: F401
