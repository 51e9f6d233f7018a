"""Hierarchical language identification with linear support vector machines.

A text becomes shares of hashed byte n-grams of its letters (square roots, so
that the vector has length one). A first layer of one-versus-one machines
picks the language family; inside a family, one-versus-one machines separate
its languages. Machines are fitted in numpy (dual coordinate descent on the
squared hinge loss) on a bounded sample: of every language the ``PER_LANG``
documents with the smallest hashes of their ids, ``TRAIN_ROWS`` at most.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
so is every text if nothing could be learned. Rows without id or language do
not train. With one language learned, every other text gets it with score 1.
Repeated rows stay; other columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fit_in_task, per_text

PER_LANG, TRAIN_ROWS = 500, 4000
#: Parts that a language's documents are sampled in.
SALTS = 64
#: Hashed n-gram buckets, and the sizes of n-grams in bytes.
BUCKETS, SIZES = 2048, (1, 2, 3)
#: Bytes of text that are taken at a time.
PIECE = 1 << 18
UNDETERMINED = "und"

#: Families of closely related languages; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk",
    "semitic": "ar he mt am",
    "indic": "hi bn ur pa mr gu ne",
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs.split()}

#: ASCII letters in lower case; every other ASCII byte is a gap. Other bytes stay.
_LETTERS = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def vector_of(text: str) -> np.ndarray:
    """Square roots of the shares of hashed n-grams, and 1 for the bias."""
    data = np.frombuffer(b" " + text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS) + b" ", np.uint8)
    counts = np.zeros(BUCKETS, np.int64)
    reach = max(SIZES) - 1
    for lo in range(0, len(data), PIECE):
        part = data[lo:lo + PIECE + reach].astype(np.uint32)
        own = min(PIECE, len(data) - lo)
        gram = np.zeros(len(part), np.uint32)
        for k in range(max(SIZES)):
            gram = gram[:len(part) - k] * np.uint32(257) + part[k:]
            if k + 1 in SIZES:
                g = (gram[:own] + np.uint32(k << 26)) * np.uint32(2654435761)
                counts += np.bincount(g >> np.uint32(32 - (BUCKETS.bit_length() - 1)), minlength=BUCKETS)
    shares = np.sqrt(counts / max(1, counts.sum()))
    return np.r_[shares, 1.0].astype(np.float32)


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def fit_machine(x: np.ndarray, y: np.ndarray, c: float = 10.0, passes: int = 30, seed: int = 0) -> np.ndarray:
    """Weights of a linear support vector machine; ``y`` is -1 or 1. Both classes weigh the same."""
    rng = np.random.default_rng(seed)
    weight = np.where(y > 0, 0.5 * len(y) / max(1, (y > 0).sum()), 0.5 * len(y) / max(1, (y < 0).sum()))
    ridge = 0.5 / (c * weight)
    diag = (x * x).sum(axis=1) + ridge
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(y))
    for _ in range(passes):
        moved = 0.0
        for i in rng.permutation(len(y)).tolist():
            grad = y[i] * (x[i] @ w) - 1 + alpha[i] * ridge[i]
            new = max(0.0, alpha[i] - grad / diag[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-4:
            break
    return w


@dataclass
class Duel:
    """One-versus-one machines over ``names``."""
    names: list[str]
    weights: np.ndarray                                   # a row per pair, in the order of combinations

    @classmethod
    def fit(cls, x: np.ndarray, names: np.ndarray) -> Duel:
        kinds = sorted(set(names.tolist()))
        rows = []
        for a, b in combinations(kinds, 2):
            on = (names == a) | (names == b)
            rows.append(fit_machine(x[on].astype(np.float64), np.where(names[on] == a, 1.0, -1.0)))
        return cls(kinds, np.array(rows, np.float32).reshape(-1, x.shape[1]))

    def decide(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the winner, its chance): most duels won, then the largest sum of margins."""
        k = len(self.names)
        if k == 1:
            return np.zeros(len(x), np.int64), np.ones(len(x))
        margins = x @ self.weights.T
        wins, total = np.zeros((len(x), k)), np.zeros((len(x), k))
        least = np.full((len(x), k), np.inf)
        for p, (a, b) in enumerate(combinations(range(k), 2)):
            m = margins[:, p]
            wins[:, a] += m > 0
            wins[:, b] += m <= 0
            total[:, a] += m
            total[:, b] -= m
            least[:, a] = np.minimum(least[:, a], m)
            least[:, b] = np.minimum(least[:, b], -m)
        best = (wins + 1e-3 * np.tanh(total)).argmax(axis=1)
        return best, 1 / (1 + np.exp(-3 * least[np.arange(len(x)), best]))


@dataclass
class Hierarchy:
    families: Duel | None
    within: dict[str, Duel]

    @classmethod
    def fit(cls, x: np.ndarray, langs: list[str]) -> Hierarchy:
        names = np.array(langs, dtype=object)
        if not len(names):
            return cls(None, {})
        family = np.array([FAMILY_OF.get(n, n) for n in langs], dtype=object)
        return cls(Duel.fit(x, family), {f: Duel.fit(x[family == f], names[family == f]) for f in set(family.tolist())})

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        if self.families is None:
            return [UNDETERMINED] * len(x), np.zeros(len(x))
        best, score = self.families.decide(x)
        out = np.empty(len(x), dtype=object)
        for k, f in enumerate(self.families.names):
            at = np.flatnonzero(best == k)
            if len(at):
                duel = self.within[f]
                won, chance = duel.decide(x[at])
                out[at] = np.array(duel.names, dtype=object)[won]
                score[at] *= chance
        return out.tolist(), score


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  usable: Column | None = None, per_lang: int = PER_LANG, rows: int = TRAIN_ROWS) -> Hierarchy:
    """Fit on the sample; ``usable`` (over ``docs``) limits the documents to learn from."""
    own = docs.filter(usable) if usable is not None else docs
    own = own.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    marked = own.filter("id is not null and lang is not null and text is not null").select("id", "lang")
    marked = marked.withColumns({"h": F.xxhash64("id", F.lit(7)), "salt": F.pmod(F.xxhash64("id", F.lit(8)), F.lit(SALTS))})

    def first(some: DataFrame, *keys: str) -> DataFrame:
        order = Window.partitionBy("lang", *keys).orderBy("h", "id")
        return some.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= per_lang)
    # of a language with any share of all rows, a task sees the candidates of one salt, then those of all salts
    sample = (first(first(marked, "salt").drop("n"))
              .orderBy("n", "h", "id", "lang").limit(rows).select("id", "lang").distinct())

    def make():
        return lambda texts: {"x": [vector_of(t).tobytes() if has_letter(t) else None for t in texts]}
    # at most ``rows`` ids are broadcast; as many vectors of BUCKETS numbers meet in one task, which sends back the machines
    found = (own.join(F.broadcast(sample), ["id", "lang"])
             .select("id", "lang", per_text(F.col("text"), make, "x binary")["x"].alias("x"))
             .filter("x is not null").groupBy("id", "lang").agg(F.max("x").alias("x")).select("lang", "id", "x"))

    def fit(held):
        held.sort(key=lambda r: r[:2])
        model = Hierarchy.fit(np.stack([np.frombuffer(x, np.float32) for _, _, x in held]), [lang for lang, _, _ in held])
        return [(d.names, d.weights) for d in (model.families, *model.within.values())], list(model.within)
    duels, families = fit_in_task(found, fit) or ([], [])
    if not duels:
        return Hierarchy(None, {})
    own_family, *within = (Duel(names, weights) for names, weights in duels)
    return Hierarchy(own_family, dict(zip(families, within, strict=True)))


def predict_language(docs: DataFrame, model: Hierarchy, text_col: str = "text", out: str = "language") -> DataFrame:
    """``docs`` with a struct column ``out``: lang (``und`` if undetermined) and score."""
    def make():
        def run(texts):
            known = [i for i, t in enumerate(texts) if has_letter(t)]
            langs, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            if known:
                found, score = model.predict(np.stack([vector_of(texts[i]) for i in known]))
                for i, g, s in zip(known, found, score.tolist(), strict=True):
                    langs[i], scores[i] = g, s
            return {"lang": langs, "score": scores}
        return run
    return docs.withColumn(out, per_text(F.col(text_col), make, "lang string, score double"))
