"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

A seed is the hash of the tokens at the care positions of a fixed mask; the
mask's other positions may hold anything. The seeds of all benchmark items are
joined with the seeds of every position of every document. A hit fixes an
alignment of item and document, and the alignment is verified: a leak is a
window of ``window`` aligned tokens of which at least ``share`` are equal.

The masks leave no gap: whichever tokens of a window may be substituted, some
mask has a placement in the window whose care positions miss all of them, so the
seeds find every leak. ``masks_for`` has masks for any window and share: for 13
tokens and a share of 0.8 (11 equal tokens) ``MASKS``, in general one mask whose
care positions are as far apart as makes them miss every substitution in some
placement. It raises where fewer than ``LEAST_CARE`` care positions would be left
(half the tokens may differ: single words would be seeds); given masks are
checked the same way.

Tokens are runs of letters and digits of the lower-cased text. Long documents
are cut into overlapping chunks of tokens, so a task's memory does not grow
with a document, and only the tokens that an item is aligned with travel to it.
The benchmark's seeds, its items and the hit documents are broadcast when their
measured bytes are at most ``MAX_BROADCAST_BYTES`` and joined by shuffle otherwise.

Defined cases: null and empty texts, and texts or items of fewer tokens than
the window, have no leaks. Items with equal tokens are searched once, under
their smallest id (null if all are null). Rows with equal id and text are one
document; rows that share only the id are judged each by its text. An empty
benchmark finds nothing. Extra columns are kept by ``remove_leaks`` and
ignored by ``find_leaks``.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import freeze

#: Care positions; they miss no two substitutions in 13 tokens.
MASKS = ((0, 1, 2, 5, 7, 8), (0, 2, 3, 5, 6, 7))
#: Tokens of a document that are taken apart at a time.
CHUNK = 1024
LEAST_CARE = 2
#: Ways to place substitutions up to which given masks are checked.
MAX_CHECKED = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20
#: Bytes of a row of two numbers and its place in a hash table; of a seed, which has two more numbers.
ROW_BYTES, SEED_BYTES = 48, 64


def covers(masks, window: int, misses: int) -> bool:
    """Whether any ``misses`` tokens of a window leave a placement of some mask untouched."""
    placed = [{p + o for p in m} for m in masks for o in range(window - max(m))]
    return all(any(not spot & hit for spot in placed) for hit in map(set, combinations(range(window), misses)))


def masks_for(window: int, share: float, masks=None) -> tuple:
    """Masks that lose no leak of ``window`` tokens of which ``share`` are equal; raises if there are none."""
    if window < 1 or not 0 < share <= 1:
        raise ValueError("a window has at least one token, a share lies in (0, 1]")
    misses = window + int(-window * share // 1)
    if masks is not None:
        if comb(window, misses) > MAX_CHECKED:
            raise ValueError(f"too many ways to place {misses} substitutions in {window} tokens to check masks")
        if not covers(masks, window, misses):
            raise ValueError(f"these masks lose leaks with {misses} substitutions in {window} tokens")
        return tuple(masks)
    if (window, misses) == (13, 2):
        return MASKS
    # of misses + 1 interleaved placements one holds no substitution
    care = window // (misses + 1)
    if care < min(LEAST_CARE, window):
        raise ValueError(f"{misses} of {window} tokens may differ: no mask has {LEAST_CARE} care positions")
    return (tuple(range(0, care * (misses + 1), misses + 1)),)


def tokens(text: Column) -> Column:
    """Runs of letters and digits of the lower-cased text, in order (null: none)."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _seeds(df: DataFrame, hashes: str, masks, first) -> DataFrame:
    """A row per mask and position: ``pos``, ``mask``, ``seed``; ``first`` is the
    position of the array's first token. The other columns stay."""
    span = 1 + max(p for m in masks for p in m)
    used = sorted({p for m in masks for p in m})
    room = F.greatest(F.size(hashes) - (span - 1), F.lit(0))
    shifted = F.arrays_zip(*(F.slice(hashes, F.lit(p + 1), room).alias(f"t{p}") for p in used))
    rows = df.select(*(c for c in df.columns if c != hashes), F.posexplode(shifted).alias("at", "t"))
    each = F.array(*(F.xxhash64(*(F.col(f"t.t{p}") for p in m)) for m in masks))
    keep = [c for c in rows.columns if c not in ("at", "t")]
    rows = rows.select(*keep, (F.col("at") + first).alias("pos"), each.alias("seeds"))
    return rows.select(*keep, "pos", F.posexplode("seeds").alias("mask", "seed"))


def _bounded(df: DataFrame, size) -> DataFrame:
    """``df`` marked for broadcast if its rows, ``size`` bytes each (a number or a column), are at most
    MAX_BROADCAST_BYTES together; otherwise it is shuffled."""
    total = df.agg(F.sum(size if isinstance(size, Column) else F.lit(size)).alias("n")).first()[0] or 0
    return F.broadcast(df) if total <= MAX_BROADCAST_BYTES else df


def _bytes(*values: str) -> Column:
    """Bytes of a row with these columns and one more number."""
    return F.lit(ROW_BYTES) + sum((F.coalesce(F.octet_length(F.col(v).cast("string")), F.lit(0)) for v in values), F.lit(0))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")) \
               .withColumn("key", F.xxhash64(F.coalesce("text", F.lit(""))))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", window: int = 13,
               share: float = 0.8, masks=None) -> DataFrame:
    """A row per document and benchmark item with a leak: the document's id,
    ``text_key`` (hash of its text), the item's id, ``n_equal`` (most equal
    tokens in a window) and ``start`` (token of the document where the first
    such window begins; of several alignments, the best and then the first)."""
    masks, least = masks_for(window, share, masks), -int(-window * share // 1)
    items = (benchmark.select(F.col(item_col).alias("item"), tokens(F.col(item_text_col)).alias("words"))
             .filter(F.size("words") >= window)
             .groupBy("words").agg(F.min("item").alias("item")))
    items = freeze(items.select("item", "words", F.xxhash64("words").alias("item_key")))
    hashed = items.select("item_key", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    item_seeds = freeze(_seeds(hashed, "hashes", masks, F.lit(0)).withColumnRenamed("pos", "item_pos"))

    span = 1 + max(p for m in masks for p in m)
    keyed = _keyed(docs, id_col, text_col)
    words = keyed.select("id", "key", F.transform(tokens(F.col("text")), lambda w: F.xxhash64(w)).alias("all"))
    last = F.greatest(F.size("all") - span, F.lit(0))     # the last position that has a seed
    cuts = F.transform(F.sequence(F.lit(0), last, F.lit(CHUNK)),
                       lambda s: F.struct(s.alias("s"), F.slice("all", s + 1, F.lit(CHUNK + span - 1)).alias("h")))
    chunks = (words.filter(F.size("all") >= window).select("id", "key", F.explode(cuts).alias("c"))
              .select("id", "key", F.col("c.s").alias("s"), F.col("c.h").alias("hashes")))
    doc_seeds = _seeds(chunks, "hashes", masks, F.col("s"))
    hits = freeze(doc_seeds.join(_bounded(item_seeds, SEED_BYTES), ["mask", "seed"])
                  .select("id", "key", "item_key", (F.col("pos") - F.col("item_pos")).alias("shift")).distinct())

    # where an item's words meet the document's: from, and how many
    sizes = items.select("item_key", F.size("words").alias("size")).distinct()
    spots = hits.join(_bounded(sizes, ROW_BYTES), "item_key").withColumn("from", F.greatest(F.lit(0), -F.col("shift")))
    wanted = _bounded(hits.select("id", "key").distinct(), _bytes("id"))
    texts = (keyed.alias("d").join(wanted.alias("w"), F.expr("d.id <=> w.id AND d.key = w.key"), "left_semi")
             .select("id", "key", "text").dropDuplicates(["id", "key"])
             .select("id", "key", tokens(F.col("text")).alias("doc_words")))
    n = F.least(F.col("size"), F.size("doc_words") - F.col("shift")) - F.col("from")
    slices = (texts.alias("d").join(spots.alias("h"), F.expr("d.id <=> h.id AND d.key = h.key")).filter(n >= window)
              .select("d.id", "d.key", "item_key", "shift", "from", n.alias("n"),
                      F.slice("doc_words", F.col("shift") + F.col("from") + 1, n).alias("doc_words")))
    held = _bounded(items, _bytes("item") + F.aggregate("words", F.lit(0), lambda a, w: a + F.octet_length(w) + 16))
    lined = slices.join(held, "item_key")
    equal = F.zip_with(F.slice("words", F.col("from") + 1, F.col("n")),
                       F.col("doc_words"),
                       lambda a, b: (a == b).cast("int"))
    sums = F.transform(F.sequence(F.lit(1), F.col("n") - (window - 1)),
                       lambda s: F.aggregate(F.slice("equal", s, F.lit(window)), F.lit(0), lambda x, y: x + y))
    judged = (lined.withColumn("equal", equal).withColumn("sums", sums)
              .withColumn("n_equal", F.array_max("sums")).filter(F.col("n_equal") >= least)
              .withColumn("start", (F.col("shift") + F.col("from") + F.array_position("sums", F.col("n_equal")) - 1)
                          .cast("int")))
    best = judged.groupBy("id", "key", "item_key").agg(
        F.min("item").alias("item"), F.max(F.struct("n_equal", (-F.col("start")).alias("back"))).alias("top"))
    return best.select(F.col("id").alias(id_col), F.col("key").alias("text_key"), F.col("item").alias(item_col),
                       F.col("top.n_equal").alias("n_equal"), (-F.col("top.back")).alias("start"))


def remove_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 **how) -> DataFrame:
    """The rows of ``docs`` without a leak, all columns kept."""
    leaks = freeze(find_leaks(docs, benchmark, id_col, text_col, **how)
                   .select(F.col(id_col).alias("id"), "text_key").distinct())
    key = F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    bad = _bounded(leaks, _bytes("id"))
    return docs.join(bad, docs[id_col].eqNullSafe(bad["id"]) & (key == bad["text_key"]), "left_anti")
