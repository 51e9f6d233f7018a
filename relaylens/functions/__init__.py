"""Column-level functions: constants, null normalisation, expressions."""

from . import constants, expr, nulls  # noqa: F401
