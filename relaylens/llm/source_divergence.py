"""Source divergence audit: how far the term use of sources differs, by a pair-task sparse merge.

A group is a language's documents of one source. Terms are runs of ASCII letters
and non-ASCII characters, A-Z lower-cased; a language keeps those that at least
``min_docs`` of its documents hold. A group (and a language) gives each kept term
the smoothed share ``p = 1 + floor(UNIT * (count + 2) / (N + 2 V))``, where N is
its number of kept terms' occurrences and V the number of kept terms; two shares
differ by ``floor((p - q)^2 / (p + q))``. All arithmetic is exact, in 64 bits.

Counting combines occurrences in the tasks before the shuffle, so a frequent term
or a large source costs one row per task. The kept terms of a language are dealt
by hash into blocks of about ``BLOCK`` and numbered inside them; a group is one
sorted (id, count) array per block. Every unordered pair of a language's groups
is a task per block: the two arrays are co-grouped and intersected by galloping,
which prices terms of both and of either side; terms that neither has are priced
by their number. A pair task therefore holds two short arrays, however large the
sources are, and each pair is priced once for both directions.

Defined cases: null texts, languages and sources are empty strings, and the empty
language and source are ordinary ones. A group without kept terms (or a language
without any: all pair values 0) takes part in the pairs. A language with one
source has no pairs. Repeated rows count as often as they come; other columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import per_value, scratch_folder

#: Whole of a share.
UNIT = 1_000_000_000
#: Terms that a pair task has to do with, on average.
BLOCK = 4096
#: Terms that a counting task holds before it passes them on.
HELD_TERMS = 400_000
#: Rows (of two names and three numbers) up to which a table of languages or groups is broadcast.
MAX_BROADCAST_ROWS = 200_000
#: Elements of the shorter array that are searched together.
RUN = 64

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and non-ASCII characters, A-Z lower-cased, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def count_terms(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """lang, source, term, ``n`` (occurrences) and ``docs`` (documents with the term)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = defaultdict(Counter)
        inside: dict = defaultdict(Counter)

        def out():
            rows = [(lang, source, t, n, inside[lang, source][t])
                    for (lang, source), c in sorted(seen.items()) for t, n in sorted(c.items())]
            seen.clear()
            inside.clear()
            kinds = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
            cols = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True) if rows else [()] * 5, kinds, strict=True)]
            cols[2] = cols[2].cast(pa.string())
            return pa.RecordBatch.from_arrays(cols, ["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                for lang, source, text in zip(*(part.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
                    terms = terms_of(text)
                    seen[lang, source].update(terms)
                    inside[lang, source].update(set(terms))
                if sum(map(len, seen.values())) > HELD_TERMS:
                    yield out()
        yield out()

    counted = _read(docs, text_col, lang_col, source_col).mapInArrow(
        count, "lang string, source string, term string, n bigint, docs bigint")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _read(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    return docs.select(*(F.coalesce(docs[c].cast("string"), F.lit("")).alias(name)
                         for c, name in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))))


# -- shares and differences, the same in SQL and numpy --------------------------------

def share(n: Column, total: Column) -> Column:
    """1 + floor(UNIT * (n + 2) / total) in 64 bits, three digits at a time (exact below a total of 9e15)."""
    out, rest = F.lit(0).cast("bigint"), n + F.lit(2).cast("bigint")
    for _ in range(3):
        rest = rest * F.lit(1000)
        out = out * F.lit(1000) + _div(rest, total)
        rest = rest % total
    return out + F.lit(1)


def difference(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def shares(n: np.ndarray, total: int) -> np.ndarray:
    """As ``share``, of an array."""
    out, rest = np.zeros(len(n), np.int64), n.astype(np.int64) + 2
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


def differences(p, q) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Place in the sorted ``long`` where each element of the sorted ``short`` is or would be. The
    search of a run starts where the last one ended, and its reach doubles until it covers the run."""
    place, at = np.empty(len(short), np.int64), 0
    for lo in range(0, len(short), RUN):
        run, step = short[lo:lo + RUN], RUN
        while at + step < len(long) and long[at + step - 1] < run[-1]:
            step *= 2
        place[lo:lo + RUN] = at + np.searchsorted(long[at:at + step], run)
        at = int(place[min(lo + RUN, len(short)) - 1])
    return place


def price(a_ids, a_n, a_total: int, b_ids, b_n, b_total: int) -> tuple[int, int]:
    """(sum of the differences over the terms that either side has, number of those terms)."""
    if len(a_ids) > len(b_ids):
        a_ids, a_n, a_total, b_ids, b_n, b_total = b_ids, b_n, b_total, a_ids, a_n, a_total
    p, q = shares(a_n, a_total), shares(b_n, b_total)
    none = np.zeros(1, np.int64)
    at = gallop(a_ids, b_ids)
    both = at < len(b_ids)
    both[both] = b_ids[at[both]] == a_ids[both]
    rest = np.ones(len(b_ids), bool)
    rest[at[both]] = False
    total = (differences(p[both], q[at[both]]).sum() + differences(p[~both], shares(none, b_total)).sum()
             + differences(shares(none, a_total), q[rest]).sum())
    return int(total), int(len(a_ids) + rest.sum())


def _priced(pair: Column) -> Column:
    """``price`` of struct rows a_ids, a_n, a_total, b_ids, b_n, b_total; a missing array has no terms."""
    def make():
        def run(batch: pa.StructArray) -> dict:
            cols = {f.name: batch.field(f.name) for f in batch.type}
            out = []
            for row in range(len(batch)):
                side = [np.asarray(x.values) if (x := cols[c][row]).is_valid else np.zeros(0, np.int64)
                        for c in ("a_ids", "a_n", "b_ids", "b_n")]
                out.append(price(side[0], side[1], cols["a_total"][row].as_py(), side[2], side[3], cols["b_total"][row].as_py()))
            return {"value": [v for v, _ in out], "terms": [n for _, n in out]}
        return run
    return per_value(pair, make, "value bigint, terms bigint")


# -- the audit ------------------------------------------------------------------------

def kept_terms(docs: DataFrame, text_col: str, lang_col: str, source_col: str, min_docs: int) -> DataFrame:
    """lang, source, term, ``n``, ``lang_n`` (occurrences in the language) and ``first`` (true in one
    row of every kept term), as a written table."""
    counts = count_terms(docs, text_col, lang_col, source_col)
    same = Window.partitionBy("lang", "term")             # a row per source: already counted
    kept = (counts.withColumns({"d": F.sum("docs").over(same), "lang_n": F.sum("n").over(same),
                                "least": F.min("source").over(same)})
            .filter(F.col("d") >= min_docs)
            .select("lang", "source", "term", "n", "lang_n", (F.col("source") == F.col("least")).alias("first")))
    folder = scratch_folder(docs.sparkSession, "divergence_terms")
    kept.write.parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_docs: int = 10, top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank. Part ``pair`` has every other source of the language
    (item) with the summed difference, all ranks; part ``term`` the ``top`` kept terms that the source
    uses more than its language. Ranks go by value, largest first, then by item."""
    kept = kept_terms(docs, text_col, lang_col, source_col, min_docs)
    langs = kept.filter("first").groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    langs = langs.withColumns({"lang_total": F.col("lang_total") + 2 * F.col("v"), "blocks": F.ceil(F.col("v") / BLOCK)})
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    groups = (_read(docs, text_col, lang_col, source_col).select("lang", "source").distinct()
              .join(own, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", F.coalesce("v", F.lit(0)).alias("v"), "lang_total",
                      (F.coalesce("own", F.lit(0)) + 2 * F.coalesce("v", F.lit(0))).alias("total")))
    folder = scratch_folder(docs.sparkSession, "divergence_groups")
    groups.write.parquet(folder)                          # a row per group
    groups = docs.sparkSession.read.parquet(folder)
    return _ranked(_pairs(kept, langs, groups), "pair", None).unionByName(_ranked(_terms(kept, groups), "term", top))


def _bounded(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if it has at most MAX_BROADCAST_ROWS rows; otherwise it is shuffled."""
    return F.broadcast(df) if df.count() <= MAX_BROADCAST_ROWS else df


def _ranked(found: DataFrame, part: str, top: int | None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    out = found.withColumn("rank", F.row_number().over(order))
    if top is not None:
        out = out.filter(F.col("rank") <= top)            # limited in every task before the shuffle
    return out.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def _terms(kept: DataFrame, groups: DataFrame) -> DataFrame:
    p, q = share(F.col("n"), F.col("total")), share(F.col("lang_n"), F.col("lang_total"))
    return (kept.join(_bounded(groups), ["lang", "source"]).withColumns({"p": p, "q": q}).filter("n > 0 and p > q")
            .select("lang", "source", F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value")))


def _pairs(kept: DataFrame, langs: DataFrame, groups: DataFrame) -> DataFrame:
    block = F.pmod(F.xxhash64("term"), F.col("blocks"))
    numbered = (kept.join(_bounded(langs.select("lang", "blocks")), "lang").withColumn("block", block)
                .withColumn("id", F.dense_rank().over(Window.partitionBy("lang", "block").orderBy("term"))))
    arrays = (numbered.groupBy("lang", "source", "block")
              .agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("x"))   # at most a block's terms
              .select("lang", "source", "block", F.col("x.id").alias("ids"), F.col("x.n").alias("n")))
    one, other = (groups.select("lang", F.col("source").alias(s), F.col("total").alias(f"{s}_total"), "v") for s in ("a", "b"))
    pairs = one.join(other.drop("v"), "lang").filter("a < b")     # the audit's own result, a row per two groups

    def side(s: str) -> DataFrame:
        mine = arrays.select("lang", F.col("source").alias(s), "block", F.col("ids").alias(f"{s}_ids"), F.col("n").alias(f"{s}_n"))
        return pairs.select("lang", "a", "b").join(mine, ["lang", s])
    tasks = side("a").join(side("b"), ["lang", "a", "b", "block"], "full_outer").join(pairs, ["lang", "a", "b"])
    parts = tasks.select("lang", "a", "b", _priced(F.struct("a_ids", "a_n", "a_total", "b_ids", "b_n", "b_total")).alias("x"))
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("x.value").alias("value"), F.sum("x.terms").alias("terms"))
    nothing = F.lit(0).cast("bigint")
    absent = F.when(F.col("v") > 0, (F.col("v") - F.coalesce("terms", nothing)) * difference(
        share(nothing, F.col("a_total")), share(nothing, F.col("b_total")))).otherwise(nothing)
    valued = (pairs.join(sums, ["lang", "a", "b"], "left")
              .select("lang", "a", "b", (F.coalesce("value", nothing) + absent).alias("value")))
    ways = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                   F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    return valued.select("lang", "value", F.explode(ways).alias("w")).select("lang", "w.source", "w.item", "value")
