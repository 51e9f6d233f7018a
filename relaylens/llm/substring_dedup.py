"""Exact removal of repeated word windows by super-k-mer partitioning.

A window is ``width`` consecutive words of one document. Its minimiser is the
smallest of its word pairs under a fixed hash order in which short pairs come
last. Consecutive windows with the same minimiser travel as one packed string
(a super-k-mer) to the minimiser's bucket, so equal windows always meet there;
a block of documents sends all its super-k-mers of one bucket as one compressed
row. The bucket sorts its windows by a hash of their bytes and compares the bytes
inside every run of equal hashes, so the counts are exact.

The windows of every bucket are counted first. A bucket of more than
``HOT_WINDOWS`` gets no super-k-mers: they are cut into single windows, and a
checksum of a window's bytes deals it to one of several buckets in its place. So
equal windows still meet, and however frequent a word pair is, a bucket holds
about as many windows as the others.

Documents are dealt into blocks first. A block sends each distinct super-k-mer
once, with the smallest and largest id that hold it, and gets back which of
its windows start in a smaller document. Copies are thereby merged before the
shuffle, and no list of the documents that hold a window ever travels: a
passage in a third of all documents costs one row per block.

Defined cases: null and empty texts have no words. Documents with fewer words
than ``width`` keep everything. Rows that share an id count as one document,
so they never remove each other's words. A null id counts as larger than all
others, and such rows do not remove each other's words. An empty table gives
an empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_ROWS, span_hashes, words_of

#: Bytes of text that a block should hold.
BLOCK_BYTES = 8 << 20
#: Bytes of text whose windows a bucket should hold (as super-k-mers about three times as much).
BUCKET_BYTES = 1 << 20
#: Windows of a bucket, repeats included, above which it is split (about three times the mean).
HOT_WINDOWS = 1 << 19
NO_ID = np.iinfo(np.int64).max
#: Windows found before a bucket task passes them on.
HELD_ANSWERS = 200_000
#: Word pairs of fewer bytes come last in the order of minimisers: they are the frequent ones.
SHORT_PAIR = 10


class Block:
    """Documents of one block in a canonical order, and their super-k-mers."""

    def __init__(self, ids: list, texts: list, width: int):
        order = sorted(range(len(ids)), key=lambda i: (NO_ID if ids[i] is None else ids[i], texts[i] or ""))
        self.ids = [ids[i] for i in order]
        self.key = np.array([NO_ID if i is None else i for i in self.ids], np.int64)
        docs = [words_of(texts[i]) for i in order]
        self.sizes = np.array([len(d) for d in docs], np.int64)
        self.width, self.n_words = width, int(self.sizes.sum())
        self.joined = joined = b" ".join([b" ".join(d) for d in docs if d])
        del docs
        data = np.frombuffer(joined + b" ", np.uint8)
        self.ends = np.flatnonzero(data == 32) if self.n_words else np.zeros(0, np.int64)
        self.starts = np.r_[0, self.ends[:-1] + 1] if self.n_words else self.ends
        self.doc_of = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.sizes)
        self._cut(data)

    def _cut(self, data: np.ndarray) -> None:
        """first, last: the windows (by first word) of every super-k-mer; mz: its minimiser."""
        k, pairs = self.width, self.width - 1
        n = self.n_words
        self.first = self.last = np.zeros(0, np.int64)
        self.mz = np.zeros(0, np.int64)
        if n < k:
            return
        s, e = self.starts[:-1], self.ends[1:]
        h = span_hashes(data, s, e) >> np.uint64(21) << np.uint64(20)
        h |= ((e - s) < SHORT_PAIR).astype(np.uint64) << np.uint64(63)
        h |= np.arange(len(h), dtype=np.uint64) & np.uint64((1 << 20) - 1)     # the leftmost of equal pairs
        low, have = h, 1
        while have < pairs:
            step = min(have, pairs - have)
            low = np.minimum(low[:-step], low[step:])
            have += step
        whole = self.doc_of[:n - k + 1] == self.doc_of[k - 1:]
        at = np.flatnonzero(whole)
        if not len(at):
            return
        cut = np.r_[True, (low[at][1:] != low[at][:-1]) | (np.diff(at) != 1)]
        self.first = at[cut]
        self.last = at[np.r_[np.flatnonzero(cut)[1:] - 1, len(at) - 1]]
        self.mz = (low[self.first] >> np.uint64(20)).view(np.int64)

    def deal(self, buckets: int, hot: np.ndarray, parts: np.ndarray) -> Block:
        """bucket: that of every super-k-mer. Those of the ``hot`` buckets (ascending) become
        single windows, each dealt to one of its ``parts`` of the buckets from ``buckets`` on."""
        self.bucket = (self.mz.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
        if not len(hot):
            return self
        at = np.minimum(np.searchsorted(hot, self.bucket), len(hot) - 1)
        split = hot[at] == self.bucket
        n = np.where(split, self.last - self.first + 1, 1)
        of = np.repeat(np.arange(len(n)), n)
        first = self.first[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        at, split = at[of], split[of]
        self.first, self.last, self.bucket = first, np.where(split, first, self.last[of]), self.bucket[of]
        sums = np.fromiter((zlib.crc32(self.joined[s:e]) for s, e in zip(
            self.starts[first[split]].tolist(), self.ends[first[split] + self.width - 1].tolist(), strict=True)), np.int64)
        self.bucket[split] = buckets + (np.cumsum(parts) - parts)[at[split]] + sums % parts[at[split]]
        return self

    def packed(self):
        """Distinct super-k-mers in order of appearance: (strings, buckets,
        smallest id, largest id, number of the string for every occurrence)."""
        seen: dict[bytes, int] = {}
        text = self.joined
        which = np.fromiter((seen.setdefault(text[s:e], len(seen)) for s, e in zip(
            self.starts[self.first].tolist(), self.ends[self.last + self.width - 1].tolist(), strict=True)),
            np.int64, len(self.first))
        if not seen:
            none = np.zeros(0, np.int64)
            return [], none, none, none, which
        order = np.argsort(which, kind="stable")
        at = np.flatnonzero(np.r_[True, np.diff(which[order]) != 0])
        key = self.key[self.doc_of[self.first]][order]
        return list(seen), self.bucket[order][at], np.minimum.reduceat(key, at), np.maximum.reduceat(key, at), which

    def keep(self, which: np.ndarray, ref: np.ndarray, least: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """For every word, whether it stays. ``ref``, ``least``, ``mask``: windows (bits of
        ``mask``) of string ``ref`` that start in document ``least``."""
        flagged = np.zeros(self.n_words + 1, np.int64)
        order = np.argsort(ref, kind="stable")
        ref, least, mask = ref[order], least[order], mask[order]
        lo, hi = np.searchsorted(ref, which, "left"), np.searchsorted(ref, which, "right")
        hit = np.flatnonzero(hi > lo)
        times = (hi - lo)[hit]
        occurrence = np.repeat(hit, times)
        answer = np.repeat(lo[hit], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        smaller = least[answer] < self.key[self.doc_of[self.first[occurrence]]]
        occurrence, answer = occurrence[smaller], answer[smaller]
        for bit in range(self.width):
            on = (mask[answer] >> bit) & 1 == 1
            flagged[self.first[occurrence[on]] + bit] = 1
        upto = np.cumsum(flagged)
        before = np.r_[np.zeros(self.width, np.int64), upto][:self.n_words]
        return upto[:self.n_words] - before == 0


def _matches(packed: list[bytes], low: np.ndarray, high: np.ndarray, width: int):
    """(string, least id, window bits) for the windows of the given strings that start in a
    document with a smaller id than some document that holds the string."""
    joined = b" ".join(packed)
    data = np.frombuffer(joined + b" ", np.uint8)
    ends = np.flatnonzero(data == 32)
    starts = np.r_[0, ends[:-1] + 1]
    first_byte = np.cumsum([0] + [len(p) + 1 for p in packed])[:-1]
    first_word = np.searchsorted(starts, first_byte)
    windows = np.diff(np.r_[first_word, len(starts)]) - (width - 1)
    string = np.repeat(np.arange(len(packed)), windows)
    bit = np.arange(len(string)) - np.repeat(np.cumsum(windows) - windows, windows)
    word = first_word[string] + bit
    s, e = starts[word], ends[word + width - 1]
    h = span_hashes(data, s, e)
    order = np.argsort(h, kind="stable")
    h = h[order]
    new = np.r_[True, h[1:] != h[:-1]]
    run = np.cumsum(new) - 1
    twin = np.flatnonzero(~new)                           # compare with the one before: equal bytes, not only hashes
    a, b = order[twin - 1], order[twin]
    unequal = [i for i, (sa, ea, sb, eb) in enumerate(zip(
        s[a].tolist(), e[a].tolist(), s[b].tolist(), e[b].tolist(), strict=True)) if joined[sa:ea] != joined[sb:eb]]
    runs = int(run[-1]) + 1
    for r in {int(run[twin[i]]) for i in unequal}:        # several windows under one hash: sort their bytes
        lone = np.flatnonzero(run == r)
        texts = [joined[s[j]:e[j]] for j in order[lone].tolist()]
        names = {t: k for k, t in enumerate(sorted(set(texts)))}
        run[lone] = [runs + names[t] for t in texts]
        runs += len(names)
    least = np.full(runs, NO_ID, np.int64)
    np.minimum.at(least, run, low[string[order]])
    mine = least[run]
    hot = mine < high[string[order]]
    order, mine = order[hot], mine[hot]
    string, bit = string[order], bit[order]
    by = np.lexsort((mine, string))
    string, mine, bit = string[by], mine[by], bit[by]
    if not len(string):
        return string, mine, bit
    at = np.flatnonzero(np.r_[True, (np.diff(string) != 0) | (np.diff(mine) != 0)])
    return string[at], mine[at], np.bitwise_or.reduceat(1 << bit, at)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 13) -> DataFrame:
    """Per document: its id, ``n_words``, ``n_removed`` and ``kept`` (the words
    that stay, joined by one space). A word goes if a window that covers it
    has the same words as a window of a document with a smaller id."""
    if not 2 <= width <= 60:
        raise ValueError("width must be between 2 and 60")
    keyed = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks, buckets = max(-(-size // BLOCK_BYTES), tasks), max(-(-size // BUCKET_BYTES), 4 * tasks)
    dealt = keyed.withColumn("block", F.pmod(F.xxhash64("id", F.octet_length("text")), F.lit(blocks)).cast("bigint"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, none = np.zeros(buckets, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for lo in range(0, len(batch), SLICE_ROWS):
                texts = batch.slice(lo, SLICE_ROWS)["text"].to_pylist()
                block = Block([None] * len(texts), texts, width).deal(buckets, none, none)
                np.add.at(windows, block.bucket, block.last - block.first + 1)
        at = np.flatnonzero(windows)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(windows[at])], ["bucket", "n"])

    large = (keyed.select("text").mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
             .filter(F.col("n") > HOT_WINDOWS).sort("bucket").collect())
    hot = np.array([r.bucket for r in large], np.int64)
    split = np.array([-(-2 * r.n // HOT_WINDOWS) for r in large], np.int64)

    def pack(table: pa.Table) -> pa.Table:
        block = Block(table["id"].to_pylist(), table["text"].to_pylist(), width).deal(buckets, hot, split)
        own = table["block"][0].as_py()
        del table
        packed, bucket, low, high, _ = block.packed()
        order = np.argsort(bucket, kind="stable")
        parts = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []
        press = zstandard.ZstdCompressor(level=3)
        return pa.table({"bucket": pa.array([int(bucket[p[0]]) for p in parts], pa.int64()),
                         "block": pa.array([own] * len(parts), pa.int64()),
                         "payload": pa.array([press.compress(_pack(packed, low, high, p)) for p in parts], pa.binary())})

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for packed, low, high, ref, block in _buckets(batches):
            string, least, mask = _matches(packed, low, high, width)
            held.append((block[string], ref[string], least, mask))
            n += len(string)
            if n >= HELD_ANSWERS:
                yield _answers(held)
                held, n = [], 0
        if held:
            yield _answers(held)

    def apply(own: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(own["id"].to_pylist(), own["text"].to_pylist(), width).deal(buckets, hot, split)
        which = block.packed()[4]
        read = lambda c, kind: np.frombuffer(b"".join(answers[c].to_pylist()), kind).astype(np.int64)
        stay = block.keep(which, read("ref", np.uint32), read("least", np.int64), read("mask", np.int64))
        at = np.cumsum(block.sizes) - block.sizes
        kept, n_removed = [], []
        for lo, n in zip(at.tolist(), block.sizes.tolist(), strict=True):
            k = stay[lo:lo + n]
            left = int(k.sum())
            n_removed.append(n - left)
            text = block.joined[block.starts[lo]:block.ends[lo + n - 1]] if n else b""
            kept.append(text if left == n else b" ".join(compress(text.split(b" "), k.tolist())))
        return pa.table({"id": pa.array(block.ids, pa.int64()), "n_words": block.sizes,
                         "n_removed": pa.array(n_removed, pa.int64()),
                         "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    sent = dealt.groupBy("block").applyInArrow(pack, "bucket bigint, block bigint, payload binary")
    answers = (sent.repartition("bucket").sortWithinPartitions("bucket")
               .mapInArrow(compare, "block bigint, ref binary, least binary, mask binary"))
    done = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        apply, "id bigint, n_words bigint, n_removed bigint, kept string")
    return done.withColumnRenamed("id", id_col)


def _pack(packed: list[bytes], low: np.ndarray, high: np.ndarray, pick: np.ndarray) -> bytes:
    """The picked super-k-mers with their numbers and ids as differences (small, so they compress)."""
    with np.errstate(over="ignore"):
        numbers = np.stack([np.diff(pick, prepend=0), np.diff(low[pick], prepend=0), (high - low)[pick]]).astype("<i8")
    return np.array([len(pick)], "<i8").tobytes() + numbers.tobytes() + b"\n".join([packed[i] for i in pick.tolist()])


def _unpack(payload: bytes):
    n = int(np.frombuffer(payload, "<i8", 1)[0])
    ref, low, more = np.frombuffer(payload, "<i8", 3 * n, 8).reshape(3, n)
    low = np.cumsum(low)
    return payload[8 + 24 * n:].split(b"\n"), low, low + more, np.cumsum(ref)


def _buckets(batches: Iterator[pa.RecordBatch]):
    """(strings, smallest ids, largest ids, numbers, blocks) of one bucket after the other."""
    def out(rows):
        found = [_unpack(zstandard.ZstdDecompressor().decompress(p)) for _, p in rows]
        return ([x for f in found for x in f[0]], *(np.concatenate([f[k] for f in found]) for k in (1, 2, 3)),
                np.repeat([b for b, _ in rows], [len(f[1]) for f in found]))

    now, rows = None, []
    for batch in batches:
        for bucket, block, payload in zip(*(batch.column(c).to_pylist() for c in ("bucket", "block", "payload")), strict=True):
            if bucket != now and rows:
                yield out(rows)
                rows = []
            now = bucket
            rows.append((block, payload))
    if rows:
        yield out(rows)


def _answers(held: list) -> pa.RecordBatch:
    """One row per block, with its numbers, ids and window bits."""
    block, ref, least, mask = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(block, kind="stable")
    parts = np.split(order, np.flatnonzero(np.diff(block[order])) + 1) if len(order) else []
    return pa.RecordBatch.from_arrays([
        pa.array([int(block[p[0]]) for p in parts], pa.int64()),
        *(pa.array([x[p].astype(kind).tobytes() for p in parts], pa.binary())
          for x, kind in ((ref, np.uint32), (least, np.int64), (mask, np.int64)))], ["block", "ref", "least", "mask"])
