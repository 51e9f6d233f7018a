"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last ``REACH`` bytes of a text decides alone where a chunk
ends: where it is -1 modulo the block size. A change in a text therefore moves
only the boundaries near it. Every chunk gives one character (of 64) to the
signature. Block sizes are ``LEAST`` times powers of two; a text takes the one
that makes about ``LENGTH`` chunks of its bytes, halved while the signature is
shorter than ``LENGTH / 4`` and doubled while it is longer than ``2 * LENGTH``
(monotonous texts). The fingerprint ``size:one:two`` has the signatures of that
block size and of twice as much, so that texts whose sizes differ by a factor of
two still share a block size.

Two fingerprints are compared at the block sizes that both have: the likeness is
1 - edit distance / length of the longer signature, and 0 unless the signatures
share ``COMMON`` characters in a row (fewer for signatures under 16: a quarter
of the shorter, at least two), as what unrelated texts share by chance counts as
nothing. Signatures are short, so a comparison's work is
bounded; the distance is computed in bit-parallel rows.

Whole texts are hashed, in pieces of ``PIECE`` bytes, so that a very long text
needs little more memory than its own.

Defined cases: a null text is read as empty; empty texts have the fingerprint
``1::``, equal fingerprints have likeness 1. Texts without a boundary are one
chunk. Repeated rows stay; other columns are kept (one with the output's name
raises).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SLICE_ROWS, per_text, per_value, scratch_folder

REACH, LEAST, LENGTH, COMMON = 7, 3, 64, 4
PIECE = 1 << 18
LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
#: Bytes of text in a range of documents (``compare_with_next``).
RANGE_BYTES = 64 << 20

# -- signatures -----------------------------------------------------------------------


def rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the last REACH bytes at every byte but the first REACH - 1."""
    wide, n = data.astype(np.uint32), len(data) - REACH + 1
    out = np.zeros(max(n, 0), np.uint32)
    for k in range(REACH if n > 0 else 0):
        out *= np.uint32(0x01000193)
        out += wide[k:k + n] + np.uint32(1)
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x2C1B3C6D)
    out ^= out >> np.uint32(13)
    return out


def _scan(data: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes at the boundaries of a block size, sums of mixed hashes before and at each, in all)."""
    ends, sums, before = [], [], np.uint64(0)
    padded = np.concatenate([np.zeros(REACH - 1, np.uint8), data])    # every byte ends a reach
    for lo in range(0, len(data), PIECE):
        h = rolling(padded[lo:lo + PIECE + REACH - 1])
        mixed = np.cumsum(h.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), dtype=np.uint64) + before
        at = np.flatnonzero(h % np.uint32(size) == size - 1)
        ends.append(h[at])
        sums.append(mixed[at])
        before = mixed[-1]
    return np.concatenate(ends), np.concatenate(sums), np.array([before], np.uint64)


def _signature(ends: np.ndarray, sums: np.ndarray, last: np.ndarray, size: int) -> bytes:
    """A character for every chunk up to a boundary, and for the rest."""
    sums = np.append(sums[ends % np.uint32(size) == size - 1], last)
    chunks = np.diff(sums, prepend=np.zeros(1, np.uint64))
    if len(chunks) > 1 and sums[-1] == sums[-2]:
        chunks = chunks[:-1]                              # the text ends with a boundary
    return LETTERS[(chunks * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(58)].tobytes()


def fingerprint_of(text: str | None) -> str:
    """The fingerprint ``size:one:two`` of a whole text."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    if not len(data):
        return "1::"
    size = LEAST
    while size * LENGTH < len(data):
        size *= 2
    found = _scan(data, size)
    while len(one := _signature(*found, size)) < LENGTH // 4 and size > LEAST:
        size //= 2
        found = _scan(data, size)
    while len(one) > 2 * LENGTH and size < len(data):
        size *= 2
        one = _signature(*found, size)                    # boundaries of the double size are among those found
    return f"{size}:{one.decode()}:{_signature(*found, 2 * size).decode()}"


# -- likeness -------------------------------------------------------------------------

def edit_distance(a: str, b: str) -> int:
    """Insertions, deletions and substitutions from one to the other; a bit for each character of ``a``."""
    if not a or not b:
        return len(a) or len(b)
    places: dict = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, out = full, 0, len(a)
    for c in b:
        eq = places.get(c, 0)
        flat = eq | down
        diag = ((eq & up) + up ^ up) | eq
        plus, minus = down | ~(diag | up) & full, up & diag
        out += bool(plus & top) - bool(minus & top)
        plus = plus << 1 | 1
        minus <<= 1
        up, down = (minus | ~(flat | plus)) & full, plus & flat & full
    return out


def _alike(a: str, b: str) -> float:
    if a == b:
        return 1.0
    k = min(COMMON, max(2, min(len(a), len(b)) // 4))
    grams = {a[i:i + k] for i in range(len(a) - k + 1)}
    if not any(b[i:i + k] in grams for i in range(len(b) - k + 1)):
        return 0.0
    return 1 - edit_distance(a, b) / max(len(a), len(b))


def likeness_of(x: str, y: str) -> float:
    """0 to 1: the best likeness at a block size that both fingerprints have."""
    if x == y:
        return 1.0
    sides = []
    for f in (x, y):
        size, one, two = f.split(":")
        sides.append({int(size): one, 2 * int(size): two})
    return max((_alike(sides[0][s], sides[1][s]) for s in sides[0].keys() & sides[1].keys() if sides[0][s] and sides[1][s]), default=0.0)


# -- documents ------------------------------------------------------------------------

def with_fingerprint(docs: DataFrame, text_col: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of every text."""
    if out.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"there is a column {out}")

    def make():
        return lambda texts: {"f": [fingerprint_of(t) for t in texts]}
    return docs.withColumn(out, per_text(F.col(text_col), make, "f string")["f"])


def likeness(one: Column, other: Column) -> Column:
    """Likeness of two columns of fingerprints; null if either is."""
    def make():
        def run(batch: pa.StructArray) -> dict:
            a, b = (batch.field(k).to_pylist() for k in ("a", "b"))
            return {"x": [None if p is None or q is None else likeness_of(p, q) for p, q in zip(a, b, strict=True)]}
        return run
    return per_value(F.struct(one.alias("a"), other.alias("b")), make, "x double")["x"]


def half_replaced(text: str, following: str) -> str:
    """The text with its last half (of its code points, rounded down) replaced by the first as many
    code points of another text, or by all that it has."""
    k = len(text) // 2
    return text[:len(text) - k] + following[:k]


_ROW = ("id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")
_NAMES = [c.split()[0] for c in _ROW.split(", ")]
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _held_against(doc, following: str, following_print: str) -> tuple:
    """The row of one document (id, text, fingerprint) and the text and fingerprint after it."""
    i, text, own = doc
    edited = half_replaced(text, following)
    changed = fingerprint_of(edited)
    return (i, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), own, changed,
            likeness_of(own, changed), likeness_of(own, following_print))


def _record(rows: list, names: list, kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document against its edited text and the next document, by ascending id (null first;
    of equal ids by a hash of the text); the first follows the last.

    Documents are dealt by ranges of ids and pass through their tasks in order, one held back. The
    last document of a range meets the first of the next range in a join of one row per range.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.col(id_col).cast("bigint").alias("id"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(-(-size // RANGE_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text").asc()]      # a sample of these goes to the driver
    dealt = keyed.repartitionByRange(ranges, *order).sortWithinPartitions(*order)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, kept = TaskContext.get().partitionId(), None, []

        def out():
            rows = kept.copy()
            kept.clear()
            return _record(rows, ["part", "edge", "edge_text", *_NAMES], [pa.int32(), pa.string(), pa.string(), *_KINDS])
        for batch in batches:
            for lo in range(0, len(batch), SLICE_ROWS):
                rows = batch.slice(lo, SLICE_ROWS)
                for i, text in zip(rows.column("id").to_pylist(), rows.column("text").to_pylist(), strict=True):
                    doc = (i, text, fingerprint_of(text))
                    if held is None:
                        kept.append((part, "first", text, i, None, None, doc[2], None, None, None))
                    else:
                        kept.append((part, None, None, *_held_against(held, text, doc[2])))
                    held = doc
                yield out()
        if held is not None:
            kept.append((part, "last", held[1], held[0], None, None, held[2], None, None, None))
            yield out()

    folder = scratch_folder(spark, "fingerprint_ranges")
    dealt.mapInArrow(walk, "part int, edge string, edge_text string, " + _ROW).write.partitionBy("edge").parquet(folder)
    table = spark.read.schema("part int, edge_text string, " + _ROW + ", edge string").parquet(folder)

    edges = table.filter("edge is not null")
    parts = sorted(r.part for r in edges.filter("edge = 'first'").select("part").collect())   # the numbers of used ranges
    after = spark.createDataFrame([(p, parts[(k + 1) % len(parts)]) for k, p in enumerate(parts)], "part int, next_part int")
    firsts = edges.filter("edge = 'first'").select(F.col("part").alias("next_part"), F.col("edge_text").alias("next_text"),
                                                   F.col("fingerprint").alias("next_print"))
    lasts = (edges.filter("edge = 'last'").join(after, "part").join(firsts, "next_part")
             .select("id", F.col("edge_text").alias("text"), "fingerprint", "next_text", "next_print"))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(k, 1).to_pylist()[0] for k in range(len(batch))):
                yield _record([_held_against((row["id"], row["text"], row["fingerprint"]), row["next_text"], row["next_print"])],
                              _NAMES, _KINDS)
    inner = table.filter("edge is null").select(*_NAMES)
    return inner.unionByName(lasts.mapInArrow(close, _ROW)).withColumnRenamed("id", id_col)
