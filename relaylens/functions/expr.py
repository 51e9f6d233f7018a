"""Column builders (projections P10–P25) and predicates.

All of them are built-in Spark expressions, so they stay inside
whole-stage code generation; none needs a Python UDF.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .nulls import clean_text, to_double


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- labels

def chain_override(address, symbol) -> Column:
    """The order-side part of :func:`classify_chain`: SOL when the address
    is not an EVM address, SONIC when the symbol is ``S`` or starts with
    ``sc``, else NULL. Computable before the join that brings the event's
    chain."""
    a, s = _c(address), _c(symbol)
    non_evm = F.when(~a.startswith(K.EVM_ADDRESS_PREFIX), F.lit(K.NON_EVM_CHAIN))
    sonic = F.when((s == K.SONIC_SYMBOL) | s.startswith(K.SONIC_SYMBOL_PREFIX), F.lit(K.SONIC_CHAIN))
    return F.coalesce(non_evm, sonic)


def classify_chain(address, symbol, chain) -> Column:
    """Chain of an order leg (P10).

    Address not starting with ``0x`` -> SOL; symbol ``S`` or starting with
    ``sc`` -> SONIC; otherwise the chain recorded on the event. A NULL
    address or symbol makes its test unknown, so the row falls through, as
    a SQL CASE does.
    """
    return F.coalesce(chain_override(address, symbol), _c(chain))


def effective_token(pre_name, give_symbol, sentinel_mode: bool = False) -> Column:
    """Input token of an order (P11): the pre-swap token when present,
    else the offered symbol.

    Default: sentinel text ('nan', 'None', '') and NULL both mean absent.
    ``sentinel_mode=True`` reproduces the literal ``= 'nan'`` test, where a
    NULL or 'None' name is kept as is.
    """
    if sentinel_mode:
        p = _c(pre_name)
        return F.when(p == "nan", _c(give_symbol)).otherwise(p)
    return F.coalesce(clean_text(pre_name), _c(give_symbol))


def scale_amount(raw, decimals) -> Column:
    """``float(raw) / 10 ** float(decimals)`` (P12); bad text -> NULL."""
    return to_double(raw) / F.pow(F.lit(10.0), to_double(decimals))


def effective_amount(pre_name, pre_amount, pre_decimals, give_amount, give_decimals,
                     sentinel_mode: bool = False) -> Column:
    """Input amount (P13): scaled pre-swap amount when a pre-swap token is
    present, else the scaled offered amount."""
    pre = scale_amount(pre_amount, pre_decimals)
    give = scale_amount(give_amount, give_decimals)
    if sentinel_mode:
        return F.when(_c(pre_name) != "nan", pre).otherwise(give)
    return F.when(clean_text(pre_name).isNotNull(), pre).otherwise(give)


def safe_divide(num, den) -> Column:
    """Division where x/0 is NULL instead of an ANSI error."""
    return F.try_divide(_c(num), _c(den))


def pair_label(in_token, out_symbol) -> Column:
    """``in-out`` (P15); NULL if either side is NULL (``concat``)."""
    return F.concat(_c(in_token), F.lit("-"), _c(out_symbol))


def route_label(src_chain, dest_chain) -> Column:
    """``src-dest`` (P16); NULL-propagating like the pair label."""
    return F.concat(_c(src_chain), F.lit("-"), _c(dest_chain))


def pair_out_leg(pair) -> Column:
    """Second element of the pair split on '-' (0-based index 1)."""
    return F.get(F.split(_c(pair), "-"), 1)


def usd_price(pair, ladder=K.USD_PRICE_LADDER, default=K.USD_PRICE_DEFAULT) -> Column:
    """USD reference price of a pair's output leg (P17): ordered LIKE rules,
    first match wins, anything else (including NULL) is ``default``."""
    leg = pair_out_leg(pair)
    rules = [(leg.like(pat), F.lit(float(price))) for pat, price in ladder]
    expr = F.when(*rules[0])
    for cond, val in rules[1:]:
        expr = expr.when(cond, val)
    return expr.otherwise(F.lit(float(default)))


# ---------------------------------------------------------------- fills

def fee(input_usd, output_usd) -> Column:
    """Fee in USD (P19): input minus output."""
    return _c(input_usd) - _c(output_usd)


def fee_fraction(input_usd, output_usd) -> Column:
    """Fee / input (P20); input 0 -> NULL."""
    return safe_divide(fee(input_usd, output_usd), input_usd)


def yield_pct(input_usd, output_usd) -> Column:
    """Fee * 100 / input (P21) — a per-fill percentage, not annualised."""
    return safe_divide(fee(input_usd, output_usd) * F.lit(100), input_usd)


def latency_micros(start, end) -> Column:
    """Exact latency in microseconds (integer)."""
    return F.unix_micros(_c(end).cast("timestamp")) - F.unix_micros(_c(start).cast("timestamp"))


def latency_seconds(start, end) -> Column:
    """Latency in (fractional) seconds (P22). ``timestampdiff(SECOND)``
    would truncate, so the microsecond difference is scaled instead."""
    return latency_micros(start, end) / F.lit(1_000_000.0)


def epoch_to_ts(seconds) -> Column:
    """Epoch seconds -> timestamp without zone."""
    return F.timestamp_seconds(_c(seconds)).cast("timestamp_ntz")


def ts_to_epoch(ts) -> Column:
    """Timestamp -> whole epoch seconds (inverse of :func:`epoch_to_ts`)."""
    return F.unix_seconds(_c(ts).cast("timestamp"))


def parse_ts(text, formats=(K.FILL_TIME_FORMAT, K.FILL_TIME_FORMAT_MILLIS)) -> Column:
    """Parse zone-labelled timestamp text; unparsable -> NULL.

    Spark's built-in string->timestamp cast already reads
    ``yyyy-MM-dd HH:mm:ss[.fraction][ zone]`` and is the fast path; the
    pattern formats are only evaluated for rows the cast rejects. The
    result is a UTC wall-clock ``timestamp_ntz`` (session zone pinned to UTC).
    """
    parsed = [_c(text).try_cast("timestamp")] + [F.try_to_timestamp(_c(text), F.lit(f)) for f in formats]
    return F.coalesce(*parsed).cast("timestamp_ntz")


def parse_iso(text) -> Column:
    """ISO-8601 text (with or without zone) -> ``timestamp_ntz`` in UTC."""
    return F.coalesce(F.try_to_timestamp(_c(text)),
                      F.try_to_timestamp(_c(text), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSXXX")),
                      F.try_to_timestamp(_c(text), F.lit("yyyy-MM-dd'T'HH:mm:ssXXX"))
                      ).cast("timestamp_ntz")


def floor_to(unit: str, ts) -> Column:
    """Time bucket (P25): ``date_trunc`` that keeps ``timestamp_ntz``."""
    return F.date_trunc(unit, _c(ts)).cast("timestamp_ntz")


def to_day(ts) -> Column:
    return F.to_date(_c(ts))


# ---------------------------------------------------------------- predicates

def id_equals(c, value) -> Column:
    """Point lookup (F1); pushed to the scan as an equality filter."""
    return _c(c) == F.lit(value)


def is_positive(c) -> Column:
    """Amount > 0 after NaN/sentinel -> NULL (F2); NULL is not kept."""
    return to_double(c) > 0


def is_filled(output_time) -> Column:
    """The transfer has an output time."""
    return _c(output_time).isNotNull()


def positive_latency(start, end) -> Column:
    """Strictly positive delay."""
    return latency_micros(start, end) > 0


def newer_than(ts, mark) -> Column:
    """Strictly newer than a high-water mark."""
    m = mark if isinstance(mark, Column) else F.lit(mark)
    return _c(ts) > m


def status_is(c, status=K.DONE_STATUS) -> Column:
    """Status filter."""
    return _c(c) == F.lit(status)


def in_range(ts, start, end) -> Column:
    """Half-open time range ``start <= ts < end``."""
    s = start if isinstance(start, Column) else F.lit(start)
    e = end if isinstance(end, Column) else F.lit(end)
    return (_c(ts) >= s) & (_c(ts) < e)


def same_token(a, b) -> Column:
    """Output symbol equals input symbol (F8); NULLs never match."""
    return _c(a) == _c(b)


def different_token(output_symbol, token_symbol, output_token) -> Column:
    """Symbols differ, with a NULL output symbol counting as different, and
    both the input symbol and the output token present (F9)."""
    return (~_c(output_symbol).eqNullSafe(_c(token_symbol))
            & _c(token_symbol).isNotNull() & _c(output_token).isNotNull())


def matches(c, like=None, prefix=None, suffix=None, contains=None,
            ignore_case: bool = False) -> Column:
    """Pattern predicates (F11), combined with AND; case-sensitive unless
    ``ignore_case``."""
    col = F.lower(_c(c)) if ignore_case else _c(c)
    norm = (lambda s: s.lower()) if ignore_case else (lambda s: s)
    preds = []
    if like is not None:
        preds.append(col.like(norm(like)))
    if prefix is not None:
        preds.append(col.startswith(norm(prefix)))
    if suffix is not None:
        preds.append(col.endswith(norm(suffix)))
    if contains is not None:
        preds.append(col.contains(norm(contains)))
    return reduce(lambda x, y: x & y, preds) if preds else F.lit(True)
