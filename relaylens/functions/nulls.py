"""Null normalisation: one entry point for text sentinels and NaN.

Spark (and DuckDB) treat ``NaN > 0`` and ``NaN = NaN`` as true and let NaN
poison sums; the workflows being reproduced (pandas, warehouse SQL) do not. We
therefore turn NaN and the text sentinels of stringified documents into SQL
NULL at the edge, after which ordinary three-valued logic gives the intended
answers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .constants import MISSING_TEXT


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c, sentinels=MISSING_TEXT) -> Column:
    """Text column with the sentinel values ('nan', 'None', '') as NULL."""
    col = _c(c)
    return F.when(col.isin(*sentinels), F.lit(None).cast("string")).otherwise(col.cast("string"))


def nan_to_null(c) -> Column:
    """Double column with NaN as NULL (``nanvl`` keeps non-NaN values)."""
    return F.nanvl(_c(c).cast("double"), F.lit(None).cast("double"))


def to_double(c, sentinels=MISSING_TEXT) -> Column:
    """Safe text -> double: sentinels, unparsable text and NaN become NULL.

    ``try_cast`` never raises under ANSI mode; note that Spark parses the
    text 'nan' as NaN, hence the sentinel step first.
    """
    return nan_to_null(clean_text(c, sentinels).try_cast("double"))


def to_long(c, sentinels=MISSING_TEXT) -> Column:
    return clean_text(c, sentinels).try_cast("long")


def normalise_frame(df: DataFrame, sentinels=MISSING_TEXT) -> DataFrame:
    """Apply :func:`clean_text` to every string column and
    :func:`nan_to_null` to every floating column, in one projection."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            cols.append(clean_text(f.name, sentinels).alias(f.name))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
