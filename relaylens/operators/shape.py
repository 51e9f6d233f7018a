"""Reshaping: column drops/renames, stringify, document flattening,
hourly event packing and unpacking, union and de-duplication.

Flattening walks the *schema* on the driver (metadata only) and emits one
``select``; no row ever leaves the executors.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import constants as K
from ..functions import expr as X


# ------------------------------------------------------------------ columns

def drop_cols(df: DataFrame, cols, strict: bool = True) -> DataFrame:
    """Drop columns (P2). Unlike ``DataFrame.drop`` a missing column is an
    error unless ``strict=False``."""
    missing = [c for c in cols if c not in df.columns]
    if strict and missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*[c for c in cols if c in df.columns])


def rename_positional(df: DataFrame, names) -> DataFrame:
    """Set all column names by position."""
    names = list(names)
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    if len(set(names)) != len(names):
        raise ValueError(f"duplicate names: {names}")
    return df.toDF(*names)


def sanitize_names(df: DataFrame, old: str = ".", new: str = "_") -> DataFrame:
    """Replace ``old`` by ``new`` in every column name (P3); raises when two
    names collide after the replacement instead of merging them."""
    mapping = {c: c.replace(old, new) for c in df.columns}
    targets = list(mapping.values())
    dups = sorted({t for t in targets if targets.count(t) > 1})
    if dups:
        raise ValueError(f"column names collide after renaming: {dups}")
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in mapping.items()])


def to_strings(df: DataFrame, null_text: str | None = None) -> DataFrame:
    """Cast every column to text (P4). Structs and arrays become JSON text.
    NULL stays NULL unless ``null_text`` (e.g. 'nan' for parity) is given."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        s = F.to_json(c) if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) \
            else c.cast("string")
        if null_text is not None:
            s = F.coalesce(s, F.lit(null_text))
        cols.append(s.alias(f.name))
    return df.select(*cols)


def with_literal(df: DataFrame, name: str, value) -> DataFrame:
    """Tag rows with a constant column (P5)."""
    return df.withColumn(name, F.lit(value))


# ------------------------------------------------------------------ flattening

def _flatten_fields(dtype: T.StructType, path: list[str], parent: Column | None,
                    sep: str, prefer: str | None, arrays_as_text: bool, mixed):
    for f in dtype.fields:
        col = F.col(f"`{f.name}`") if parent is None else parent.getField(f.name)
        name_path = path + [f.name]
        dt = f.dataType
        if isinstance(dt, T.StructType):
            others = T.StructType([x for x in dt.fields if x.name != prefer])
            if prefer is None or len(others) == len(dt):
                yield from _flatten_fields(dt, name_path, col, sep, prefer, arrays_as_text, mixed)
                continue
            # An object carrying the preferred key collapses to it. Keys that
            # objects of this path have instead of it stay beside.
            yield sep.join(name_path), col.getField(prefer)
            others = T.StructType([x for x in others.fields if sep.join([*name_path, x.name]) in mixed])
            for n, c in _flatten_fields(others, name_path, col, sep, prefer, arrays_as_text, mixed):
                yield n, F.when(col.getField(prefer).isNull(), c)
        elif arrays_as_text and isinstance(dt, (T.ArrayType, T.MapType)):
            yield sep.join(name_path), F.to_json(col)
        else:
            yield sep.join(name_path), col


def _wrapped_paths(dtype: T.StructType, path: list[str], parent: Column | None, sep: str, prefer: str):
    """(flat name of another key, condition: the object has it but not the preferred one)."""
    for f in dtype.fields:
        if isinstance(f.dataType, T.StructType):
            col = F.col(f"`{f.name}`") if parent is None else parent.getField(f.name)
            others = [x.name for x in f.dataType.fields if x.name != prefer]
            if others and len(others) < len(f.dataType):
                for n in others:
                    yield sep.join([*path, f.name, n]), col.getField(prefer).isNull() & col.getField(n).isNotNull()
            yield from _wrapped_paths(f.dataType, path + [f.name], col, sep, prefer)


def mixed_paths(df: DataFrame, sep: str = "_", prefer: str = K.STRING_VALUE_KEY) -> set[str]:
    """Flat names of the keys that objects have instead of the ``prefer`` key, where
    others of the same path carry it: one aggregate over all rows, one boolean per key."""
    found = list(_wrapped_paths(df.schema, [], None, sep, prefer))
    if not found:
        return set()
    row = df.agg(*[F.bool_or(c).alias(f"m{i}") for i, (_, c) in enumerate(found)]).first()
    return {name for (name, _), hit in zip(found, row, strict=True) if hit}


def flatten_struct(df: DataFrame, sep: str = "_", prefer: str | None = K.STRING_VALUE_KEY,
                   arrays_as_text: bool = True, mixed=None) -> DataFrame:
    """Recursively flatten nested structs into ``a<sep>b<sep>c`` columns.

    An object that has a ``prefer`` key (default ``stringValue``) collapses to
    that value, document by document: other keys whose flat names are in
    ``mixed`` become columns too, for the objects without it (NULL where it is
    present). ``mixed=None`` finds these names in the data (:func:`mixed_paths`,
    one more pass if any object can have both); pass ``()`` where the feed never
    mixes. Lists become JSON text. Raises if two paths produce the same flat
    name (e.g. ``a.b_c`` and ``a_b.c`` with ``sep='_'``).
    """
    if mixed is None:
        mixed = mixed_paths(df, sep, prefer) if prefer is not None else ()
    pairs = list(_flatten_fields(df.schema, [], None, sep, prefer, arrays_as_text, set(mixed)))
    names = [n for n, _ in pairs]
    dups = sorted({n for n in names if names.count(n) > 1})
    if dups:
        raise ValueError(f"flattened names collide: {dups}")
    return df.select(*[c.alias(n) for n, c in pairs])


#: A back-quoted key, or a type word of a variant's schema text (a key name is followed by a colon).
_TYPE_WORD = re.compile(r"`(?:[^`]|``)*`|\bOBJECT(?=<)|\b(?:VOID|VARIANT|DECIMAL\(\d+,\s*\d+\))(?=\s*(?:[,>]|$))")


def infer_json_schema(df: DataFrame, col: str) -> str:
    """Merged schema of a JSON text column over *all* rows, as a
    ``from_json`` DDL string (drift mode for documents kept in a column).

    One distributed aggregate (``schema_of_variant_agg``) merges the keys of
    every document; only the schema string reaches the driver. Keys that are
    always null or that hold several types become STRING, fractional numbers
    DOUBLE, objects STRUCT; text that is not JSON is ignored.
    """
    ddl = df.select(F.schema_of_variant_agg(F.try_parse_json(F.col(col)))).first()[0]
    if ddl is None:
        return "STRUCT<>"
    types = {"O": "STRUCT", "V": "STRING", "D": "DOUBLE"}
    return _TYPE_WORD.sub(lambda m: types.get(m[0][0], m[0]), ddl)


def flatten_json_column(df: DataFrame, col: str, schema: str | None = None, sep: str = "_",
                        prefer: str | None = K.STRING_VALUE_KEY) -> DataFrame:
    """Parse a JSON text column (declared ``schema``, or inferred over all
    rows when ``None``) and flatten it into ``<col><sep><path>`` columns
    beside the other columns (P7/P9 for documents stored as text).
    Unparsable text gives NULL fields."""
    schema = schema or infer_json_schema(df, col)
    return flatten_struct(df.withColumn(col, F.from_json(F.col(col), schema)), sep=sep, prefer=prefer)


def _variant_leaves(kind: T.DataType, names: list[str], path: str):
    """(flat name parts, variant path, type) of every value that is not an object in all documents."""
    if not isinstance(kind, T.StructType):
        yield names, path, kind
        return
    for f in kind.fields:
        quote = "'" if "'" not in f.name else '"'
        if quote in f.name:
            raise ValueError(f"a key with both quotes has no variant path: {f.name}")
        yield from _variant_leaves(f.dataType, [*names, f.name], f"{path}[{quote}{f.name}{quote}]")


def shred_json_column(df: DataFrame, col: str, sep: str = "_", keep: str | None = None) -> DataFrame:
    """Documents kept as JSON text -> one column per path, no value lost (P7, drift mode).

    The types are merged over all rows, as in :func:`infer_json_schema`. A path whose values
    agree becomes a typed column ``<col><sep><path>``, lists JSON text. A path that
    is a number here and text or an object there becomes a VARIANT column with every value
    as it came (:func:`variant_kinds` takes it apart); :func:`flatten_json_column` reads
    such a path as text. With ``keep`` the whole document stays beside as a VARIANT
    of that name. Text that is not JSON gives NULLs; documents that are no objects appear in
    the ``keep`` column only. Names that collide raise.
    """
    ddl = df.select(F.schema_of_variant_agg(F.try_parse_json(F.col(col)))).first()[0]
    types = {"O": "STRUCT", "D": "DOUBLE"}

    def word(m):
        return m[0] if m[0] == "VARIANT" else "STRING" if m[0] == "VOID" else types.get(m[0][0], m[0])

    kind = T.DataType.fromDDL(_TYPE_WORD.sub(word, ddl)) if ddl else T.StructType([])
    out = [(c, F.col(f"`{c}`")) for c in df.columns if c != col]
    for names, path, leaf in _variant_leaves(kind, [col], "$") if isinstance(kind, T.StructType) else ():
        as_text = isinstance(leaf, T.ArrayType)
        value = F.try_variant_get(F.col("__doc"), path, "variant" if as_text else leaf.simpleString())
        out.append((sep.join(names), F.to_json(value) if as_text else value))
    if keep:
        out.append((keep, F.col("__doc")))
    found = [n.lower() for n, _ in out]
    dups = sorted({n for n in found if found.count(n) > 1})
    if dups:
        raise ValueError(f"shredded names collide: {dups}")
    return df.withColumn("__doc", F.try_parse_json(F.col(col))).select(*[c.alias(n) for n, c in out])


def variant_kinds(df: DataFrame, col: str, sep: str = "_") -> DataFrame:
    """Columns of a VARIANT column's values by kind, beside it: ``_text``, ``_number`` (double; the
    VARIANT holds all digits), ``_flag`` and ``_json`` (objects and lists as JSON text)."""
    v = F.col(f"`{col}`")
    kind = F.schema_of_variant(v)
    number = kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")

    def of(cond, as_type):
        return F.when(cond, F.try_variant_get(v, "$", as_type))
    return df.withColumns({
        f"{col}{sep}text": of(kind == "STRING", "string"), f"{col}{sep}number": of(number, "double"),
        f"{col}{sep}flag": of(kind == "BOOLEAN", "boolean"),
        f"{col}{sep}json": F.when(kind.rlike("^(OBJECT|ARRAY)"), F.to_json(v))})


def expand_structs(df: DataFrame, cols, sep: str = ".", keep: bool = True, drop=()) -> DataFrame:
    """Normalise the given struct columns and paste their leaves beside the
    original columns (P8); the struct's own name is not part of the leaf
    names, as with a per-column JSON normalise. Columns and leaves named in
    ``drop`` are left out first, so a leaf may repeat a dropped column's name;
    any other repeated name raises."""
    base = [c for c in df.columns if c not in drop and (keep or c not in cols)]
    out = [(c, F.col(f"`{c}`")) for c in base]
    for c in cols:
        st = df.schema[c].dataType
        if not isinstance(st, T.StructType):
            raise TypeError(f"{c} is not a struct")
        out += [(n, col) for n, col in _flatten_fields(st, [], F.col(f"`{c}`"), sep, None, False, ()) if n not in drop]
    names = [n for n, _ in out]
    dups = sorted({n for n in names if names.count(n) > 1})
    if dups:
        raise ValueError(f"expanded names collide: {dups}")
    return df.select(*[c.alias(n) for n, c in out])


# ------------------------------------------------------------------ packing

def part_of(item, parts: int) -> Column:
    """Number of the sub-group (0 to ``parts - 1``) that an item belongs to.

    Used wherever a group is collected into one value (a packed cell, a JSON
    page): the caller fixes ``parts`` for the largest group it expects, so a
    key holding a large share of all rows is collected by ``parts`` tasks, and
    the output's shape does not depend on how many rows a group has."""
    if parts < 1:
        raise ValueError("parts must be at least 1")
    item = F.col(item) if isinstance(item, str) else item
    return F.lit(0) if parts == 1 else F.pmod(F.xxhash64(item), F.lit(parts)).cast("int")


def pack_events(df: DataFrame, ts: str = "evt_block_time", id_col: str = "orderid",
                cat: str = "chain", categories=K.PACK_CHAINS, start=None, end=None,
                time_format: str = "yyyy-MM-dd HH:mm:ss.SSSSSS",
                parts: int = 1, ordered: bool = True) -> DataFrame:
    """Hourly packed event log.

    One row per hour with one text column per category: the ``', '``-joined
    ``<id>-<time>`` items of that category, sorted, ``''`` when none.

    A packed cell is a single value that one task collects. Where an hour can
    hold a large share of all events, ``parts`` spreads every hour over that
    many sub-rows (``part = hash(item) mod parts``, empty ones left out) and
    keeps every item; :func:`unpack_events` reads any number of parts.
    """
    ev = df
    if start is not None or end is not None:
        cond = F.lit(True)
        if start is not None:
            cond = cond & (F.col(ts) >= F.lit(start).cast("timestamp_ntz"))
        if end is not None:
            cond = cond & (F.col(ts) < F.lit(end).cast("timestamp_ntz"))
        ev = ev.where(cond)
    item = F.concat(F.col(id_col).cast("string"), F.lit(K.PACK_FIELD_SEP),
                    F.date_format(F.col(ts), time_format))
    ev = ev.select(X.floor_to("hour", ts).alias("event_hour"), item.alias("item"),
                   F.col(cat).alias("cat"))
    ev = ev.withColumn("part", part_of("item", parts))
    aggs = [F.array_join(F.sort_array(F.collect_list(F.when(F.col("cat") == v, F.col("item")))),
                         K.PACK_ITEM_SEP).alias(name)
            for v, name in categories]
    packed = ev.groupBy("event_hour", "part").agg(*aggs)
    # The export is ordered by hour (O2); a writer that does not need row
    # order passes ordered=False and saves the global sort.
    return packed.orderBy("event_hour", "part") if ordered else packed


def unpack_events(df: DataFrame, id_cols=None, chain_col: str = "chain",
                  id_name: str = "orderId", time_name: str = "evt_time") -> DataFrame:
    """Wide packed cells -> one row per event.

    For every column except ``id_cols`` (default: the first column, plus
    ``part`` when present): split the cell on ``', '``, split each item once
    on the first ``-`` into id and time (dashes of the time are kept), tag
    it with the column name, and drop rows with any NULL (items without a
    ``-`` and empty cells).
    """
    if id_cols is None:
        id_cols = [df.columns[0]] + (["part"] if "part" in df.columns else [])
    value_cols = [c for c in df.columns if c not in id_cols]
    long = df.unpivot(id_cols, value_cols, chain_col, "__cell")
    items = long.select(F.col(chain_col), F.explode(F.split("__cell", K.PACK_ITEM_SEP)).alias("__item"))
    parts = F.split("__item", K.PACK_FIELD_SEP, 2)
    out = items.select(F.get(parts, 0).alias(id_name), F.get(parts, 1).alias(time_name),
                       F.col(chain_col))
    return out.dropna("any")


# ------------------------------------------------------------------ union / dedupe

def union_by_name(frames) -> DataFrame:
    """Stack frames by column name; missing columns are NULL."""
    frames = list(frames)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def dedupe_rows(df: DataFrame, subset=None) -> DataFrame:
    """Drop duplicate rows (U3); the partial aggregate removes repeats
    before the shuffle."""
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def dedupe_page_edges(pages: DataFrame, envelope: str, ts: str, by=(), block: int = 86400) -> DataFrame:
    """Records of pages whose cursor includes its ends, each once.

    Neighbouring pages repeat the records of the moment where they meet, so only records at
    a page's first or last time (or without one) can come again on another page: these are exchanged,
    all others stay where they were read. Repeats inside a page are dropped within its array.

    That holds where the pages of one series (``by``, e.g. the folder column) do not overlap beyond
    their ends. It is checked first, with a narrow row per page and ``block`` of time (in the
    unit of ``ts``, a whole number); where it does not hold, all records are exchanged. The result
    is the same: the distinct rows.
    """
    by = [by] if isinstance(by, str) else list(by)
    rows = F.array_distinct(F.col(envelope))
    times = F.filter(F.transform(rows, lambda r: r[ts]), lambda t: t.isNotNull())
    own = pages.withColumns({envelope: rows, "__first": F.array_min(times), "__last": F.array_max(times)})
    keep = [F.col(c) for c in pages.columns if c != envelope]
    records = own.select(*keep, "__first", "__last", F.inline(envelope))
    if _pages_overlap(own, by, block):
        return records.drop("__first", "__last").dropDuplicates()
    at_edge = F.col(ts).isNull() | (F.col(ts) == F.col("__first")) | (F.col(ts) == F.col("__last"))
    inner = records.where(~at_edge).drop("__first", "__last")
    return inner.unionByName(records.where(at_edge).drop("__first", "__last").dropDuplicates())


def _pages_overlap(pages: DataFrame, by, block: int) -> bool:
    spans = pages.where("__first IS NOT NULL").select(*by, "__first", "__last")
    spans = spans.withColumn("__block", F.explode(F.sequence(F.floor(F.col("__first") / block), F.floor(F.col("__last") / block))))
    order = Window.partitionBy(*by, "__block").orderBy("__first", "__last").rowsBetween(Window.unboundedPreceding, -1)
    return not spans.withColumn("__seen", F.max("__last").over(order)).where("__first < __seen").isEmpty()
