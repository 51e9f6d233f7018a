"""Helpers shared by the text operators."""

from __future__ import annotations

import pickle
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relaylens.session import checkpoint_root

#: Rows handed to Python code at a time inside one Arrow batch.
SLICE_ROWS = 256
#: Rows of an Arrow batch at most.
BATCH_ROWS = 1024


def freeze(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder, so a
    lost executor costs a re-read, not a recomputation."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for a written table, in the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def kept_in_worker(key, make: Callable):
    """``make()``, once in the life of a Python worker: later tasks of the same worker, which get
    their functions anew, find the object in a module that only serves as its place."""
    place = sys.modules.setdefault("_relaylens_worker", types.ModuleType("_relaylens_worker")).__dict__
    if key not in place:
        place[key] = make()
    return place[key]


def bound_batches(spark: SparkSession) -> None:
    """Let at most BATCH_ROWS rows travel to Python at a time (fewer if the session says so): texts are long,
    and a task holds whole batches on both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table, in a session whose batches are bounded (``bound_batches``)."""
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def per_value(value: Column, make: Callable[[], Callable[[pa.Array], dict]], ddl: str) -> Column:
    """Struct column computed from one column in Arrow batches.

    ``make()`` runs once per task and returns a function from an Arrow array to
    a dict of equally long lists or arrays, one per struct field. Only this
    column travels to Python; other columns stay in the JVM.
    """

    @F.arrow_udf(ddl)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fn, kind = make(), arrow_struct(ddl)
        for batch in batches:
            for lo in range(0, len(batch), SLICE_ROWS):       # results leave by slices, so none pile up
                cols = fn(batch.slice(lo, SLICE_ROWS))
                yield pa.StructArray.from_arrays(
                    [c if isinstance(c := cols[f.name], pa.Array) else pa.array(c, f.type) for f in kind],
                    fields=list(kind))
        pa.default_memory_pool().release_unused()             # the worker waits for other tasks

    return run(value)


def per_text(text: Column, make: Callable[[], Callable[[list], dict]], ddl: str) -> Column:
    """As ``per_value`` for a text column; the function gets a list of texts, ``None`` for null."""
    def from_list():
        fn = make()
        return lambda part: fn(part.to_pylist())
    return per_value(text.cast("string"), from_list, ddl)


def arrow_struct(ddl: str) -> pa.StructType:
    """Arrow struct type of a flat ``struct<name:type,...>`` or ``name type, ...`` DDL text."""
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
             "boolean": pa.bool_(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()),
             "array<bigint>": pa.list_(pa.int64()), "array<float>": pa.list_(pa.float32()),
             "array<string>": pa.list_(pa.string())}
    return pa.struct([(n, kinds[t]) for n, t in (x.strip().split(" ", 1) for x in ddl.split(","))])


def fit_in_task(rows: DataFrame, fit: Callable[[list], object]):
    """What ``fit`` makes of a bounded sample's rows (a list of tuples), computed in one task, so that the
    driver neither holds the sample nor spends its time; None if there is no row. The result must be made of
    plain values and arrays, as executors have no copy of this package."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(held))], pa.binary())], ["model"])
    found = rows.repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(found.model) if found else None


def words_of(text: str | None) -> list[bytes]:
    """Runs of characters other than space and \\t\\n\\v\\f\\r, as UTF-8 (null: none)."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def span_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, piece: int = 1 << 16) -> np.ndarray:
    """64-bit polynomial hashes of byte spans (ascending starts), equal for equal bytes wherever
    the spans lie. Equal hashes do not prove equal bytes. Memory is that of ``piece`` spans."""
    out = np.empty(len(starts), np.uint64)
    for at in range(0, len(starts), piece):
        s, e = starts[at:at + piece], ends[at:at + piece]
        base, stop = int(s[0]), int(e.max())
        powers, inverse = _powers(stop - base + 1)
        prefix = np.zeros(stop - base + 1, np.uint64)
        np.cumsum((buffer[base:stop].astype(np.uint64) + np.uint64(1)) * powers[:-1], out=prefix[1:])
        out[at:at + piece] = (prefix[e - base] - prefix[s - base]) * inverse[s - base]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return out


_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_TABLES: list = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES or len(_TABLES[0]) < n:
        size = max(n, 1 << 16)
        up = np.full(size, _MULTIPLIER, np.uint64)
        down = np.full(size, pow(_MULTIPLIER, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _TABLES[:] = [np.cumprod(up), np.cumprod(down)]
    return _TABLES[0][:n], _TABLES[1][:n]
