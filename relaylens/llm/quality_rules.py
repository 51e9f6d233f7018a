"""Quality rules by distribution divergence.

Every language of the corpus, however rare, has two reference histograms,
counted over all its documents: character classes, and common words (those that
make up at least ``WORD_SHARE`` of its words, and one bin for all others). A
document is compared with every reference by the Jensen-Shannon distance (square
root of the divergence in bits, 0 to 1) and keeps the nearest. It fails if that
distance is above the limit. Short texts vary by chance: a histogram of fewer
than ``MIN_CHARS`` characters or ``MIN_WORDS`` words gives no verdict, and a
language with fewer in all is no reference for a text with more.

Defined cases: null and empty texts have zero counts and fail the base rules.
Documents without a language take part in no reference and are judged like any
other. Without any reference (an empty table, no language) only the base rules
hold. Repeated rows stay; other columns are kept.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_text, words_of
from .doc_stats import CLASSES, base_counts, class_counts

#: A common word is at least this share of its language's words, so a language has at most 1000.
WORD_SHARE = 0.001
MIN_CHARS, MIN_WORDS = 300, 60
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.27, 0.5
#: Different words that a task counts before it passes its counts on.
HELD_WORDS = 300_000

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
DDL = (", ".join(f"{c} bigint" for c in BASE) + ", base_failed boolean, kept boolean, nearest string,"
       " class_distance double, word_distance double")


def plain(word: bytes) -> bytes:
    """A word for the histograms: ASCII lower case, without punctuation around it."""
    return word.lower().strip(b".,;:!?\"'()")


def build_references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict:
    """{language: (class counts, {common word: count}, count of all words)}, from whole texts of
    all documents that have a language."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chars: dict = defaultdict(lambda: np.zeros(len(CLASSES), np.int64))
        words: dict = defaultdict(Counter)

        def out():
            rows = [(g, "class", str(k).encode(), int(n)) for g, c in chars.items() for k, n in enumerate(c) if n]
            rows += [(g, "word", w, n) for g, c in words.items() for w, n in c.items()]
            rows += [(g, "words", b"", sum(c.values())) for g, c in words.items()]
            for held in (chars, words):
                held.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(
                zip(*rows, strict=True) if rows else ([], [], [], []), (pa.string(), pa.string(), pa.binary(), pa.int64()),
                strict=True)], ["g", "kind", "item", "n"])

        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                for lang, text in zip(part.column("g").to_pylist(), part.column("t").to_pylist(), strict=True):
                    chars[lang] += class_counts((text or "").encode("utf-8", "surrogatepass"))
                    words[lang].update(map(plain, words_of(text)))
                if sum(map(len, words.values())) > HELD_WORDS:
                    yield out()
        yield out()

    counts = (docs.select(F.col(lang_col).cast("string").alias("g"), F.col(text_col).cast("string").alias("t"))
              .filter("g is not null").mapInArrow(count, "g string, kind string, item binary, n bigint")
              .groupBy("g", "kind", "item").agg(F.sum("n").alias("n")))
    totals = counts.groupBy("g", "kind").agg(F.sum("n").alias("total"))
    kept = (counts.alias("c").join(totals.alias("t"), ["g", "kind"])
            .filter(f"kind <> 'word' OR (n >= total * {WORD_SHARE} AND length(item) > 0)"))
    rows = kept.collect()                                 # at most 1000 words and a few classes a language
    out = {r.g: (np.zeros(len(CLASSES)), {}, 0) for r in rows}
    for r in rows:
        if r.kind == "class":
            out[r.g][0][int(bytes(r.item))] = r.n
        elif r.kind == "word":
            out[r.g][1][bytes(r.item)] = r.n
        else:
            out[r.g] = (*out[r.g][:2], r.n)
    return out


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two count vectors: 0 for equal shares, 1 for nothing in common."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2

    def part(x):
        on = x > 0
        return float((x[on] * np.log2(x[on] / m[on])).sum())
    return float(np.sqrt(min(1.0, max(0.0, (part(p) + part(q)) / 2))))


def judge(docs: DataFrame, references: dict, text_col: str = "text", out: str = "quality",
          min_words: int = 20, max_repeat_percent: int = 30, max_class_distance: float = MAX_CLASS_DISTANCE,
          max_word_distance: float = MAX_WORD_DISTANCE) -> DataFrame:
    """``docs`` with a struct column ``out``: the base counts, ``base_failed``, ``kept``, and the
    nearest reference with its distances (null where the text is too short to tell)."""
    names = sorted(references)

    def make():
        sets = []
        for g in names:
            classes, words, total = references[g]
            index = {w: i for i, w in enumerate(words)}
            sets.append((classes, index, np.array([*words.values(), max(0, total - sum(words.values()))], float)))

        def one(text):
            words = words_of(text)
            row = base_counts(text or "", words)
            failed = row["n_words"] < min_words or 100 * row["n_repeat_words"] > max_repeat_percent * row["n_words"]
            classes, tally, best = class_counts((text or "").encode("utf-8", "surrogatepass")), None, None
            told = classes.sum() >= MIN_CHARS, len(words) >= MIN_WORDS
            for g, (ref_classes, index, ref_words) in zip(names, sets, strict=True):
                if told[0] and ref_classes.sum() < MIN_CHARS or told[1] and ref_words.sum() < MIN_WORDS:
                    continue                              # no document of that language is as long
                by_class = by_word = None
                if told[0]:
                    by_class = js_distance(classes, ref_classes)
                if told[1]:
                    tally = tally or Counter(map(plain, words))
                    mine = np.zeros(len(ref_words))
                    for w in tally.keys() & index.keys():
                        mine[index[w]] = tally[w]
                    mine[-1] = len(words) - mine.sum()
                    by_word = js_distance(mine, ref_words)
                rank = (by_class or 0) / max_class_distance + (by_word or 0) / max_word_distance
                if best is None or rank < best[0]:
                    best = (rank, g, by_class, by_word)
            _, nearest, by_class, by_word = best or (0, None, None, None)
            row |= {"base_failed": failed, "nearest": nearest, "class_distance": by_class, "word_distance": by_word,
                    "kept": not failed and (by_class or 0) <= max_class_distance and (by_word or 0) <= max_word_distance}
            return row

        def run(texts):
            rows = [one(t) for t in texts]
            return {c.split()[0]: [r[c.split()[0]] for r in rows] for c in DDL.split(",")}
        return run

    return docs.withColumn(out, per_text(F.col(text_col), make, DDL))
