"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints are sorted by their rank in the reflected Gray code, so that
neighbours share most bits. Ranges of that order are the groups of the index.
Every node holds the bit pattern that all fingerprints below it share, and a
child's pattern leaves out what its parent already holds: a search adds up
differences on the way down and drops a whole node once they exceed the limit.

* Upper nodes (at most ``MAX_GROUPS`` leaves) go to every task. They tell
  which groups a fingerprint must visit.
* Lower nodes are built in the task that holds a group's members; visitors
  stream past them.
* A task reports links only while they connect something new (a spanning
  forest), so a dense cluster gives as many rows as it has fingerprints, not
  their pairs. Components are then merged by star contraction.

Defined cases: null and empty texts have fingerprint zero and link like any
other. Repeated rows stay. Rows with a null id stay; they take their
component's smallest id, null if it has none. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freeze, per_text

#: Distinct fingerprints per group, until MAX_GROUPS groups are reached.
GROUP_SIZE = 1 << 15
#: Bound on the leaves of the upper index, and so on what every task receives
#: (two 64-bit words each).
MAX_GROUPS = 65536
FANOUT = 16


# -- fingerprints ------------------------------------------------------------

def fingerprints_of(texts: list, shingle: int = 3, seed: int = 42) -> np.ndarray:
    """64-bit SimHash of each text as signed integers (null and empty: zero)."""
    out = np.zeros(len(texts), np.uint64)
    for i, text in enumerate(texts):
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            continue
        runs = [words] if len(words) < shingle else zip(*(words[k:] for k in range(shingle)), strict=False)
        h = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(seed)), np.uint64)
        ones = np.zeros(64, np.int64)
        for lo in range(0, len(h), 1 << 16):
            part = h[lo:lo + (1 << 16)].view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[i] = np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0]
    return out.view(np.int64)


def add_fingerprint(docs: DataFrame, text_col: str, out: str, shingle: int = 3) -> DataFrame:
    """``docs`` with the fingerprint (bigint) of ``text_col`` in column ``out``."""
    def make():
        return lambda texts: {"fp": fingerprints_of(texts, shingle)}
    return docs.withColumn(out, per_text(F.col(text_col), make, "fp bigint")["fp"])


def gray_rank(fp):
    """Sort key (signed) in the order of the reflected Gray code."""
    r = fp
    for s in (1, 2, 4, 8, 16, 32):
        r = r.bitwiseXOR(F.shiftrightunsigned(r, s))
    return r.bitwiseXOR(F.lit(-(1 << 63)))


# -- the index ---------------------------------------------------------------

class GrayIndex:
    """Tree over (mask, bits) patterns in Gray order; the lowest level is the
    given patterns, every node above factors out what ``FANOUT`` children share."""

    def __init__(self, mask: np.ndarray, bits: np.ndarray):
        full = [(mask, bits & mask)]
        while len(full[-1][0]) > FANOUT:
            m, b = full[-1]
            at = np.arange(0, len(m), FANOUT)
            low, high = np.bitwise_and.reduceat(b, at), np.bitwise_or.reduceat(b, at)
            shared = np.bitwise_and.reduceat(m, at) & ~(low ^ high)
            full.append((shared, low & shared))
        self.levels = []                                  # top down: what the parent lacks
        for k in range(len(full) - 1, -1, -1):
            m, b = full[k]
            if k + 1 < len(full):
                m = m & ~np.repeat(full[k + 1][0], FANOUT)[:len(m)]
            self.levels.append((m, b & m))

    def search(self, queries: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, lowest-level entry) index pairs whose accumulated difference
        is at most ``limit``."""
        n = len(self.levels[0][0])
        q = np.repeat(np.arange(len(queries)), n)
        node = np.tile(np.arange(n), len(queries))
        far = np.zeros(len(q), np.uint8)
        for k, (mask, bits) in enumerate(self.levels):
            if k:
                size = len(mask)
                node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                q, far = np.repeat(q, FANOUT), np.repeat(far, FANOUT)
                real = node < size
                q, node, far = q[real], node[real], far[real]
            far = far + np.bitwise_count((queries[q] ^ bits[node]) & mask[node])
            near = far <= limit
            q, node, far = q[near], node[near], far[near]
        return q, node


class Forest:
    """Union-find over 0..n-1 with fully compressed labels."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.members = {}

    def unite(self, a: int, b: int) -> bool:
        x, y = int(self.label[a]), int(self.label[b])
        if x == y:
            return False
        mx, my = self.members.pop(x, [x]), self.members.pop(y, [y])
        if len(mx) < len(my):
            x, y, mx, my = y, x, my, mx
        self.label[my] = x
        mx.extend(my)
        self.members[x] = mx
        return True


def _group_links(members: np.ndarray, visitors: Iterator[np.ndarray], limit: int, step: int = 256):
    """Spanning links of one group: among its members, and from visitors to them."""
    order = np.argsort(_rank(members), kind="stable")
    members = members[order]
    index = GrayIndex(np.full(len(members), ~np.uint64(0)), members)
    forest = Forest(len(members))

    def take(queries: np.ndarray, own: bool, first: int = 0):
        q, m = index.search(queries, limit)
        if not len(q):
            return
        new = np.r_[True, q[1:] != q[:-1]]                # pairs come ordered by query
        lead = (np.arange(len(queries)) + first)[q] if own else m[new][np.cumsum(new) - 1]
        if not own:
            yield queries[q[new]], m[new]
        todo = np.flatnonzero(forest.label[lead] != forest.label[m])
        made = [(int(lead[i]), int(m[i])) for i in todo if forest.unite(int(lead[i]), int(m[i]))]
        if made:
            a, b = np.array(made).T
            yield members[a], b

    def ordered(queries: np.ndarray, own: bool):
        for lo in range(0, len(queries), step):
            for a, b in take(queries[lo:lo + step], own, lo):
                yield a, members[b]

    yield from ordered(members, True)
    for block in visitors:
        yield from ordered(block, False)


def _rank(fp: np.ndarray) -> np.ndarray:
    r = fp.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


def link_fingerprints(distinct: DataFrame, limit: int = 2) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) of at most
    ``limit`` differing bits: a spanning set, so that connectivity is whole."""
    n = distinct.count()
    groups = max(1, min(MAX_GROUPS, -(-n // GROUP_SIZE)))
    placed = freeze(distinct.select("fp").repartitionByRange(groups, gray_rank(F.col("fp")))
                    .withColumn("grp", F.spark_partition_id()))
    # one row a group: at most MAX_GROUPS (or the partitions Spark was told to make)
    top = placed.groupBy("grp").agg(F.bit_and("fp").alias("low"), F.bit_or("fp").alias("high")).orderBy("grp").collect()
    ids = np.array([r.grp for r in top], np.int32)
    low = np.array([r.low for r in top], np.int64).view(np.uint64)
    high = np.array([r.high for r in top], np.int64).view(np.uint64)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper = GrayIndex(~(low ^ high), low)
        for batch in batches:
            fps, own = batch.column("fp").to_numpy(), batch.column("grp").to_numpy()
            for lo in range(0, len(fps), 2048):
                f, g = fps[lo:lo + 2048], own[lo:lo + 2048]
                q, node = upper.search(f.view(np.uint64), limit)
                to = ids[node]
                later = to >= g[q]                        # the other direction is the other one's visit
                q, to = q[later], to[later]
                order = np.lexsort((to != g[q], to))      # neighbours in Gray order visit the same groups together
                q, to = q[order], to[order]
                away = to != g[q]
                cuts = np.flatnonzero(np.r_[True, (np.diff(to) != 0) | (np.diff(away) != 0)]) if len(q) else order
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to[cuts]), pa.array(away[cuts].astype(np.int32)),
                     pa.array([f[x].tobytes() for x in np.split(q, cuts[1:])] if len(q) else [], pa.binary())],
                    ["grp", "visitor", "fps"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for members, visitors in _runs(batches):
            for a, b in _group_links(members, visitors, limit):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    if not top:
        return placed.select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    visits = placed.mapInArrow(route, "grp int, visitor int, fps binary")
    return (visits.repartition(groups, "grp").sortWithinPartitions("grp", "visitor")
            .mapInArrow(search, "a bigint, b bigint"))


def _runs(batches: Iterator[pa.RecordBatch]):
    """(members, iterator of visitor blocks) for each group of a sorted stream."""
    def pieces():
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("grp", "visitor", "fps")), strict=True):
                yield row[0], bool(row[1]), np.frombuffer(row[2], np.uint64)

    stream = pieces()
    piece = next(stream, None)
    while piece:
        grp, blocks = piece[0], []
        while piece and piece[0] == grp and not piece[1]:
            blocks.append(piece[2])
            piece = next(stream, None)

        def visitors():
            nonlocal piece
            while piece and piece[0] == grp:
                yield piece[2]
                piece = next(stream, None)
        rest = visitors()
        yield np.concatenate(blocks) if blocks else np.zeros(0, np.uint64), rest
        for _ in rest:                                    # whatever the caller left
            pass


# -- components --------------------------------------------------------------

def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node with a link; ``root`` is the smallest node
    of its component. Alternating large and small stars, each step a
    checkpoint, until the links no longer change."""
    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            both = both.unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        else:
            both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        near = both.join(low, "u")
        out = near.filter("v > u" if large else "v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        if not large:
            out = out.unionAll(low.filter("u <> m").select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.filter("a <> b").distinct()

    def mark(edges: DataFrame):
        return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    edges = freeze(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while (now := mark(edges)) != before:
        before = now
        edges = freeze(star(star(edges, True), False))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, limit: int = 2) -> DataFrame:
    """One row per document: its id, ``fp`` (bigint) and ``component_id``, the
    smallest id reachable over links of at most ``limit`` bits."""
    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    prints = freeze(add_fingerprint(keyed, "text", "fp", shingle).select("id", "fp"))
    rooted = _rooted(prints.groupBy("fp").agg(F.min("id").alias("least")), limit)
    best = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(best, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def _rooted(distinct: DataFrame, limit: int) -> DataFrame:
    """``distinct`` (a row per ``fp``) with the ``root`` of each fingerprint's component."""
    roots = components(link_fingerprints(distinct, limit))
    return (distinct.join(roots, distinct.fp == roots.node, "left")
            .select(*(distinct[c] for c in distinct.columns), F.coalesce("root", "fp").alias("root")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = 3, limit: int = 2) -> DataFrame:
    """The rows of ``docs`` that stay: of every component the one with the smallest id (null
    counts as largest), then with the smallest hash of its text, then of its values."""
    names = {c.lower() for c in docs.columns}
    key, row = (next(n for k in range(len(names) + 1) if (n := f"{x}_{k}") not in names) for x in ("key", "row"))
    text = F.col(text_col).cast("string")
    own = docs.withColumn(key, F.xxhash64(F.coalesce(text, F.lit("")), text.isNull()))
    prints = freeze(add_fingerprint(own.select(F.col(id_col).alias("id"), F.col(key).alias("key"), text.alias("text")),
                                    "text", "fp", shingle).select("fp", "id", "key"))
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "key")
    rooted = _rooted(prints.groupBy("fp").agg(F.min(order).alias("least")), limit)
    stays = rooted.groupBy("root").agg(F.min("least").alias("s")).select(F.col("s.id").alias("stay_id"), F.col("s.key").alias("stay_key"))
    kept = own.join(stays, (own[key] == stays.stay_key) & own[id_col].eqNullSafe(stays.stay_id), "left_semi")
    as_text = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in docs.columns]
    best = kept.groupBy(key, id_col).agg(F.min_by(F.struct(*(F.col(f"`{c}`") for c in docs.columns)), F.xxhash64(*as_text)).alias(row))
    return best.select(f"{row}.*")
