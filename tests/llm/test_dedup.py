"""Substring dedup, SimHash and decontamination against brute force."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from relaylens.llm import decontamination, simhash, substring_dedup

from .conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_repeats(rows, width=13):
    big = float("inf")
    first = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for k in range(len(w) - width + 1):
            s = tuple(w[k:k + width])
            first[s] = min(first.get(s, big), big if i is None else i)
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k:k + width])] < (big if i is None else i):
                gone.update(range(k, k + width))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return collections.Counter(out)


@pytest.mark.parametrize("width", [2, 13])
def test_remove_repeats(docs, rows, width):
    got = substring_dedup.remove_repeats(docs, width=width)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept"]
    assert collections.Counter(map(tuple, got.collect())) == brute_repeats([r[:2] for r in rows], width)


def test_remove_repeats_hot_and_overlapping(spark):
    rng = random.Random(1)
    pool = [prose(rng, 20, ["a", "b"]) for _ in range(6)]
    rows = [(i, " ".join(rng.sample(pool, 3))) for i in range(60)] + [(i, "a " * rng.randint(10, 60)) for i in range(60, 90)]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert collections.Counter(map(tuple, got.collect())) == brute_repeats(rows)


@pytest.mark.parametrize("width", [2, 13])
def test_remove_repeats_split_buckets(docs, rows, width, monkeypatch):
    monkeypatch.setattr(substring_dedup, "HOT_WINDOWS", 20, raising=False)
    got = substring_dedup.remove_repeats(docs, width=width)
    assert collections.Counter(map(tuple, got.collect())) == brute_repeats([r[:2] for r in rows], width)


def test_frequent_pair_makes_no_large_bucket(spark, monkeypatch):
    """A pair of long words with differing neighbours in every document."""
    pairs = [f"boilerplate{k} licence{k}".encode() for k in range(300)]
    pair = min(pairs, key=lambda p: substring_dedup.span_hashes(np.frombuffer(p, np.uint8), np.array([0]), np.array([len(p)]))[0])
    rng = random.Random(8)
    some = lambda n: " ".join("".join(rng.choices("abcdefgh", k=4)) for _ in range(n))
    left, right = some(12), some(12)
    rows = [(i, f"{some(14)} {pair.decode()} {some(14)}" if i % 5 else f"{some(3)} {left} {pair.decode()} {right}") for i in range(600)]
    real = substring_dedup._matches

    def bounded(packed, low, high, width):
        assert sum(len(p.split()) - width + 1 for p in packed) <= 1500
        return real(packed, low, high, width)

    monkeypatch.setattr(substring_dedup, "_matches", bounded)
    monkeypatch.setattr(substring_dedup, "HOT_WINDOWS", 1500, raising=False)
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert collections.Counter(map(tuple, got)) == brute_repeats(rows) and sum(r.n_removed for r in got) > 1000


def test_equal_hashes_are_compared(monkeypatch):
    monkeypatch.setattr(substring_dedup, "span_hashes", lambda data, s, e: np.zeros(len(s), np.uint64))
    low, high = np.array([1, 5, 2]), np.array([1, 5, 9])
    string, least, mask = substring_dedup._matches([b"a b c", b"a b d", b"x y"], low, high, 2)
    assert sorted(zip(string.tolist(), least.tolist(), mask.tolist(), strict=True)) == [(1, 1, 1), (2, 2, 1)]


def test_remove_repeats_empty(no_docs):
    assert substring_dedup.remove_repeats(no_docs).collect() == []


def brute_fingerprint(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [w[k:k + 3] for k in range(len(w) - 2)] if len(w) >= 3 else [w] if w else []
    h = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, prints):
    big = float("inf")
    label = [big if i is None else i for i in ids]
    near = [[k for k, q in enumerate(prints) if (p ^ q).bit_count() <= 2] for p in prints]
    while (new := [min(label[k] for k in n) for n in near]) != label:
        label = new
    return [None if x == big else x for x in label]


def test_near_duplicates(docs, rows):
    got = simhash.near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id").collect()
    ids, prints = [r[0] for r in rows], [brute_fingerprint(r[1]) for r in rows]
    want = zip(ids, [f"{p:016x}" for p in prints], brute_components(ids, prints), strict=True)
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)
    assert any(r.component_id != r.doc_id for r in simhash.near_duplicates(docs).collect())


def test_links_over_many_groups(spark, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP_SIZE", 32)
    rng = np.random.default_rng(0)
    flip = lambda x, n: x ^ int(sum({1 << int(b) for b in rng.integers(0, 64, n)}))
    prints = {flip(int(b), int(rng.integers(0, 4))) for b in rng.integers(0, 1 << 63, 60) for _ in range(6)}
    prints |= {flip(12345, 2) for _ in range(200)} | {0, (1 << 64) - 1}
    prints = np.array(sorted(prints), np.uint64)
    found = simhash.components(simhash.link_fingerprints(
        spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp bigint"))).collect()
    own = dict(zip(prints.view(np.int64).tolist(), brute_components(prints.view(np.int64).tolist(), prints.tolist()), strict=True))
    assert {r.node: r.root for r in found} == {k: v for k, v in own.items() if k != v}


def test_keep_one(docs, rows):
    kept = simhash.keep_one(docs).collect()
    groups = set(brute_components(range(len(rows)), [brute_fingerprint(r[1]) for r in rows]))
    assert len(kept) == len(groups)                       # id 7 stays twice: two texts, two groups
    assert {r.doc_id for r in kept} == {r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert simhash.keep_one(docs).columns == docs.columns
    assert {tuple(r) for r in kept} <= set(rows)


def test_near_duplicates_empty(no_docs):
    assert simhash.near_duplicates(no_docs).collect() == []
    assert simhash.keep_one(no_docs).collect() == []


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute_leaks(rows, items, window=13, least=11):
    out = {}
    merged = {}
    for item, text in items:
        t = tuple(tokens(text))
        merged[t] = min((x for x in (merged.get(t), item) if x is not None), default=None)
    for i, text in rows:
        d = tokens(text)
        for t, item in merged.items():
            for shift in range(-len(t), len(d)):
                for k in range(len(t) - window + 1):
                    if shift + k >= 0 and shift + k + window <= len(d):
                        n = sum(a == b for a, b in zip(t[k:k + window], d[shift + k:shift + k + window], strict=True))
                        if n >= least:
                            at = (i, text, item)
                            out[at] = max(out.get(at, (0, 0)), (n, -shift - k))
    return {(i, item, n, -s) for (i, _, item), (n, s) in out.items()}


def test_find_leaks(spark, docs, rows):
    rng = random.Random(2)
    vocabulary = [f"v{i}" for i in range(400)]
    items = [(k, prose(rng, n, vocabulary)) for k, n in enumerate([13, 14, 20, 40, 60])]
    items += [(9, items[2][1]), (None, items[3][1]), (10, "too short for a window"), (11, None)]
    extra = []
    for k, (_, text) in enumerate(items[:5]):
        for miss in (0, 1, 2, 3):
            words = text.split()
            for at in rng.sample(range(len(words)), miss):
                words[at] = "other"
            extra.append((100 + 10 * k + miss, f"Before {' '.join(words).upper()}, after"))
            extra.append((200 + 10 * k + miss, " ".join(words[:13])))
    extra += [(300, items[4][1][100:] + " x " * 3000 + items[2][1]), (None, items[3][1]), (100, items[1][1]), (100, items[1][1])]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    mine = spark.createDataFrame(extra, "doc_id bigint, text string")
    got = decontamination.find_leaks(mine, bench)
    assert {(r.doc_id, r.item_id, r.n_equal, r.start) for r in got.collect()} == brute_leaks(extra, items)
    left = decontamination.remove_leaks(mine.withColumn("id", F.lit(1)).withColumn("key", F.lit(2)), bench)
    bad = {(i, t) for i, t in extra if brute_leaks([(i, t)], items)}
    assert collections.Counter((r.doc_id, r.text) for r in left.collect()) == collections.Counter(
        x for x in extra if x not in bad)
    assert decontamination.find_leaks(docs, bench).collect() == []
    assert decontamination.remove_leaks(docs, bench).count() == len(rows)


@pytest.mark.parametrize("chunk", [64, 1024])
def test_leaks_at_the_end_of_a_chunk(spark, monkeypatch, chunk):
    """Two substitutions in the last 13 tokens of a document, for all ends around a chunk's."""
    monkeypatch.setattr(decontamination, "CHUNK", chunk)
    item = [f"t{i}" for i in range(13)]
    mine = []
    for size in range(chunk + 8, chunk + 15):
        for a, b in itertools.combinations(range(13), 2):
            words = [f"f{i}" for i in range(size - 13)] + [w if i not in (a, b) else "other" for i, w in enumerate(item)]
            mine.append((10_000 * size + 100 * a + b, " ".join(words)))
    got = decontamination.find_leaks(spark.createDataFrame(mine, "doc_id bigint, text string").repartition(8),
                                     spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string"))
    assert {(r.doc_id, r.n_equal, r.start) for r in got.collect()} == {(i, 11, i // 10_000 - 13) for i, _ in mine}


def test_leaks_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "MAX_BROADCAST_BYTES", 0)
    text = " ".join(f"t{i}" for i in range(20))
    bench = spark.createDataFrame([(1, text)], "item_id bigint, text string")
    mine = spark.createDataFrame([(5, "a b " + text), (6, "a b c")], "doc_id bigint, text string")
    assert [tuple(r) for r in decontamination.find_leaks(mine, bench).select("doc_id", "item_id", "start").collect()] == [(5, 1, 2)]
    assert [r.doc_id for r in decontamination.remove_leaks(mine, bench).collect()] == [6]


@pytest.mark.parametrize(("window", "share"), [(8, 1.0), (13, 0.69), (13, 0.85), (20, 0.9), (6, 0.66), (1, 1.0), (9, 0.5)])
def test_leaks_of_any_window_and_share(spark, window, share):
    """Every planted leak is found, whatever the window and share, or none can be looked for."""
    rng = random.Random(window)
    least = -int(-window * share // 1)
    if window // (window - least + 1) < min(2, window):
        with pytest.raises(ValueError, match="care positions"):
            decontamination.masks_for(window, share)
        return
    assert decontamination.covers(decontamination.masks_for(window, share), window, window - least)
    vocabulary = [f"v{i}" for i in range(300)]
    items = [(k, prose(rng, n, vocabulary)) for k, n in enumerate([window, window + 1, 3 * window])]
    mine = []
    for k in range(60):
        words = rng.choice(items)[1].split()
        for at in rng.sample(range(len(words)), min(len(words), rng.randint(0, window - least + 1))):
            words[at] = "other"
        mine.append((k, f"{prose(rng, rng.randint(0, 30))} {' '.join(words)} {prose(rng, rng.randint(0, 30))}"))
    got = decontamination.find_leaks(spark.createDataFrame(mine, "doc_id bigint, text string"),
                                     spark.createDataFrame(items, "item_id bigint, text string"), window=window, share=share)
    assert {(r.doc_id, r.item_id, r.n_equal, r.start) for r in got.collect()} == brute_leaks(mine, items, window, least)


def test_masks_that_lose_leaks_raise():
    with pytest.raises(ValueError, match="lose leaks"):
        decontamination.masks_for(13, 0.69, decontamination.MASKS)
    with pytest.raises(ValueError, match="lies in"):
        decontamination.masks_for(13, 0)
    assert decontamination.masks_for(13, 0.85, decontamination.MASKS) == decontamination.MASKS


def test_masks_miss_no_pair_of_substitutions():
    for a in range(13):
        for b in range(13):
            assert any(a - o not in m and b - o not in m for m in decontamination.MASKS for o in range(13 - m[-1]))


def test_leaks_empty(spark, docs, no_docs):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.find_leaks(docs, bench).collect() == []
    assert decontamination.remove_leaks(no_docs, bench).collect() == []


def test_leaks_plan_runs_no_python(spark, docs):
    bench = spark.createDataFrame([(1, "x " * 20)], "item_id bigint, text string")
    plan = decontamination.find_leaks(docs, bench)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_kept_hash(docs):
    one = substring_dedup.remove_repeats(docs.filter("doc_id = 0")).select("kept", F.sha2("kept", 256).alias("h")).first()
    assert one.h == hashlib.sha256(one.kept.encode()).hexdigest()
