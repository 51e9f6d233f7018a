"""Source divergence, conversation repair and fingerprints against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from relaylens.llm import conversation_repair as C
from relaylens.llm import fingerprint as P
from relaylens.llm import source_divergence as D

# -- source divergence ----------------------------------------------------------------


def brute_divergence(rows, min_docs, top=10):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    term = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    docs = [(lang or "", source or "", term.findall((text or "").translate(low))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        spread = Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t, n in spread.items() if n >= min_docs)
        groups = {s: Counter(t for d in own if d[1] == s for t in d[2]) for s in {d[1] for d in own}}
        whole = sum(groups.values(), Counter())

        def shares(c):
            total = sum(c[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 2) // total for t in kept}
        p, q = {s: shares(c) for s, c in groups.items()}, shares(whole)

        def f(a, b):
            return (a - b) ** 2 // (a + b)
        for s in groups:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in groups if o != s]
            terms = [(-f(p[s][t], q[t]), t.encode()) for t in kept if groups[s][t] > 0 and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                out += [(lang, s, part, i.decode(), -v, r) for r, (v, i) in enumerate(sorted(found)[:limit], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def sourced():
    rng = random.Random(3)
    words = [f"{a}{b}" for a in "ÄéÉaBcZ漢" for b in "xyzWvuñ"]
    rows = [(rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "é", "S9", None]),
             " ".join(rng.choices(words, [1 / k for k in range(1, len(words) + 1)], k=rng.randint(0, 40)))) for _ in range(120)]
    return rows + [("en", "s1", None), ("fr", "lone", "one two"), ("xx", "a", ""), ("xx", "b", None), ("en", "only", "zzz"),
                   ("de", "s1", "a b 1c2d\x00e_f " * 3000)] + rows[:5]


@pytest.mark.parametrize(("min_docs", "block"), [(10, 4096), (3, 4), (1, 7)])
def test_divergence_is_brute_force(spark, sourced, monkeypatch, min_docs, block):
    monkeypatch.setattr(D, "BLOCK", block)
    docs = spark.createDataFrame([(*r, 1, "t") for r in sourced], "lang string, source string, text string, n bigint, term string")
    got = D.audit(docs.repartition(3), min_docs=min_docs).collect()
    assert sorted(map(tuple, got)) == brute_divergence(sourced, min_docs)


def test_divergence_without_rows(spark, no_docs):
    assert D.audit(no_docs).collect() == []


def test_shares_are_exact():
    for n, total in ((0, 7), (6, 8), (9 * 10**14, 8 * 10**15), (8 * 10**15 - 2, 8 * 10**15)):
        assert int(D.shares(np.array([n]), total)[0]) == 1 + 10**9 * (n + 2) // total


def test_gallop_is_binary_search():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 3000, rng.integers(0, 400) * k)) for k in (1, 5))
        assert (D.gallop(a, b) == np.searchsorted(b, a)).all() if len(a) else len(D.gallop(a, b)) == 0


# -- conversation repair ----------------------------------------------------------------

SPACE = " \t\n\x0b\x0c\r"


def every_repair(turns):
    """(cost, audit) of the best edits of (initial, cost of staying or None to go) turns, by phases."""
    step = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    def inserts(states):
        for _ in range(2):
            for p in list(states):
                for x, after in step[p].items():
                    one = (states[p][0] + 3, states[p][1] + "I")
                    if x != "s" and (after not in states or one < states[after]):
                        states[after] = one
        return states
    states = inserts({0: (0, "")})
    for initial, stay in turns:
        new: dict = {}

        def put(after, cost, audit, new=new):
            if after not in new or (cost, audit) < new[after]:
                new[after] = (cost, audit)
        for p, (cost, audit) in states.items():
            put(p, cost + 4, audit + "D")
            if stay is not None:
                for x, after in step[p].items():
                    if x == initial:
                        put(after, cost + stay, audit + "K")
                    elif x != "s":
                        put(after, cost + stay + 3, audit + "R")
        states = inserts(new)
    return min(states[p] for p in (0, 3) if p in states)


def brute_repairs(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, kinds = set(), []
        for _, role, text in own:
            kinds.append("blank" if not text.strip(SPACE) else "duplicate" if (role, text) in seen
                         else "truncated" if text.strip(SPACE)[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit = every_repair([(r[:1], None if k in ("blank", "duplicate") else 3 * (k == "truncated"))
                                    for (_, r, _), k in zip(own, kinds, strict=True)])
        numbers = {t for t, *_ in own if t is not None}
        length, lines, at = len(audit) - audit.count("D"), [], 0
        for x in audit:
            due = ("suaua"[len(lines) - 2 * ((len(lines) - 1) // 2) if lines else 0] if length % 2 else "ua"[len(lines) % 2])
            full = {"s": "system", "u": "user", "a": "assistant"}[due]
            if x == "I":
                lines.append(f"{full}:")
                continue
            _, role, text = own[at]
            at += 1
            if x != "D":
                assert x == "R" or role[:1] == due
                lines.append(f"{role if x == 'K' else full}:{text}")
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        out[conv] = (gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, lines)
    return out


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(8)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "usher", "", None]
    texts = ["Yes.", "No", "Why?", "  ", "", None, "end!\n", "So\x0c", "漢字。", "x" * 5000 + "."]
    rows = [(c, rng.choice([None, *range(9)]) if c % 3 == 0 else t, rng.choice(roles),
             rng.choice(texts) if rng.random() < 0.4 else f"turn {rng.randint(0, 50)}" + rng.choice(["", "."]))
            for c in range(150) for t in range(rng.randint(1, 9))]
    rows += [(900, t, rng.choice(roles[:5]), f"{rng.randint(0, 300)}" + rng.choice(["", ".", ".", "."])) for t in range(600)]
    rows += [(901, 5, "user", "same.")] * 40 + [(902, t, "system", "s.") for t in range(30)]
    return rows + [(None, 1, "user", "who?"), (None, 2, None, "me"), (903, None, "assistant", "a."), (903, None, "user", "b.")]


def test_repairs_are_brute_force(spark, turns):
    df = spark.createDataFrame([(*r, "x", 1) for r in turns], "conv_id bigint, turn bigint, role string, text string, conv string, part int")
    audits = C.audit(df.repartition(5)).cache()
    got, want = {r.conv_id: tuple(r)[1:] for r in audits.collect()}, brute_repairs(turns)
    assert got == {c: w[:-1] for c, w in want.items()}
    lines: dict = {}
    for r in sorted(C.repair(df, audits).collect(), key=lambda r: r.place):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert lines == {c: w[-1] for c, w in want.items() if w[-1]}
    digests = {r.conv_id: r.sha256 for r in C.repaired_digests(df, audits).collect()}
    assert digests == {c: hashlib.sha256("\n".join(w[-1]).encode()).hexdigest() for c, w in want.items()}


def test_runs_join_as_one():
    """Cutting into runs and ranges changes neither cost nor audit."""
    rng = random.Random(2)
    for _ in range(300):
        turns = [(rng.choice("uasuat"), rng.choice([0, 0, 3, None])) for _ in range(rng.randint(0, 40))]
        pieces, lo = [], 0
        while lo < len(turns) or not pieces:
            hi = lo + rng.randint(1, 25)
            piece = C.Piece(1, range(4) if pieces else (C.START,))
            for k, (initial, stay) in enumerate(turns[lo:hi]):
                piece.add(lo + k, initial, stay is None, False, stay == 3, 1)
            pieces.append(piece.row(len(pieces)))
            lo = hi
        gone = sum(s is None for _, s in turns)
        assert C.repaired(pieces)[6:] == every_repair(turns), (turns, gone)


def test_band_loses_nothing():
    rng = random.Random(4)
    for _ in range(300):
        turns = tuple((rng.choice("uas"), rng.choice([0, 3])) for _ in range(rng.randint(0, 9)))
        want = C.target(rng.choice("sua"), rng.randint(1, 9))
        full = C.align(turns, want, 10_000)
        if full is None:
            assert want[0] == "s" and all(i != "s" for i, _ in turns)
            continue
        assert C.align(turns, want, full[0]) == full and C.align(turns, want, full[0] - 1) is None


def test_repair_without_rows(spark):
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert C.audit(none).collect() == [] and C.repaired_digests(none, C.audit(none)).collect() == []


# -- fingerprints -------------------------------------------------------------------------

def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance_is_plain():
    rng = random.Random(6)
    for _ in range(500):
        a, b = ("".join(rng.choices("abc", k=rng.randint(0, 80))) for _ in "ab")
        assert P.edit_distance(a, b) == plain_distance(a, b)


def test_signature_is_chunk_by_chunk(monkeypatch):
    """The vectorised signature against one byte at a time, at any size of the pieces."""
    rng = random.Random(9)
    text = "".join(rng.choices("abcdef ghi.é漢", k=3000))
    data, mask = text.encode(), (1 << 64) - 1

    def plain(size):
        out, total = "", 0
        for k in range(len(data)):
            h = 0
            for b in (bytes(6) + data)[k:k + 7]:
                h = (h * 0x01000193 + b + 1) % (1 << 32)
            h ^= h >> 15
            h = h * 0x2C1B3C6D % (1 << 32)
            h ^= h >> 13
            total = total + h * 0x9E3779B97F4A7C15 & mask
            if h % size == size - 1 or k == len(data) - 1:
                out += chr(P.LETTERS[(total * 0xD6E8FEB86659FD93 & mask) >> 58])
                total = 0
        return out
    whole = P.fingerprint_of(text)
    size = int(whole.split(":")[0])
    assert whole == f"{size}:{plain(size)}:{plain(2 * size)}"
    monkeypatch.setattr(P, "PIECE", 100)
    assert P.fingerprint_of(text) == whole


def test_likeness():
    rng = random.Random(7)
    text, other = (" ".join(f"w{rng.randint(0, 500)}" for _ in range(800)) for _ in "ab")
    f = P.fingerprint_of
    assert P.likeness_of(f(text), f(text)) == 1 and P.likeness_of(f(text), f(other)) == 0
    assert P.likeness_of(f(text), f(text[:1000] + "new words" + text[1000:])) > 0.85
    assert 0.3 < P.likeness_of(f(text), f(P.half_replaced(text, other))) < 0.7
    assert P.likeness_of(f(text), f(text + text[:len(text) // 3])) > 0.5       # another block size
    assert P.likeness_of(f(""), f("")) == 1 and P.likeness_of(f(""), f(text)) == 0


def test_next_documents_are_brute_force(spark, docs, rows, no_docs):
    got = sorted((tuple(r) for r in P.compare_with_next(docs).collect()), key=str)
    texts = [(r[0], r[1] or "") for r in rows]
    hashed = {t: h for t, h in spark.createDataFrame([(t,) for t in {t for _, t in texts}], "t string").selectExpr("t", "xxhash64(t)").collect()}
    texts.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashed[r[1]]))
    want = []
    for k, (i, t) in enumerate(texts):
        after = texts[(k + 1) % len(texts)][1]
        edited = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
        f, g = P.fingerprint_of(t), P.fingerprint_of(edited)
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), f, g, P.likeness_of(f, g), P.likeness_of(f, P.fingerprint_of(after))))
    assert got == sorted(want, key=str)
    assert P.compare_with_next(no_docs).collect() == []


def test_fingerprint_column(spark, docs):
    both = P.with_fingerprint(P.with_fingerprint(docs.select("doc_id", "text", "fp"), out="one"), out="two")
    found = both.withColumn("x", P.likeness(both["one"], both["two"])).collect()
    assert all(r.one == P.fingerprint_of(r.text) and r.x == 1 for r in found)
    with pytest.raises(ValueError, match="FP"):
        P.with_fingerprint(docs, out="FP")


def test_one_document(spark):
    one = spark.createDataFrame([(1, "alone with itself")], "doc_id bigint, text string")
    (r,) = P.compare_with_next(one).collect()
    assert r.near_next == 1 and r.n_chars == 17
