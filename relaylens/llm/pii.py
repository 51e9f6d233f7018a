"""Personal data: fixed patterns, and a character-level tagger that adds to them.

The tagger is a bidirectional LSTM over characters with CRF transitions between
tags (none, or one per kind). It is trained in numpy from labelled spans: the
pattern spans of a bounded sample of documents, and rewritten forms of them and
of made-up data that the patterns do not cover (``rewrite``). A text is cut into
windows that overlap by ``OVERLAP``; the windows of many texts are decoded side by
side, one character of all of them at a time. A span within ``MARGIN`` of a window's
edge inside the text may be incomplete: the neighbour window holds it whole, or else wider
windows around it are decoded until one does, so spans may have any length. Where
neighbours find different spans of one place, a wider window is decoded too. Of
whole spans the best scored wins where they overlap, over the whole text. Pattern
spans always stay; the tagger's spans must not overlap them, must score at least
``MIN_SCORE`` and hold what their kind needs (``plausible``). Windows in which
nothing can be plausible (``may_hold``) need no decoding.

Spans are (kind, start, end) in code points, end exclusive.

Defined cases: null and empty texts have no spans, and ``redact`` keeps them.
Without any span to learn from (an empty table) only the patterns hold.
Repeated rows stay; other columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fit_in_task, per_text

KINDS = ("email", "ip", "card", "phone")
WINDOW, OVERLAP = 512, 64
#: Characters at a window's edge inside a text where it decides nothing.
MARGIN = 16
#: Windows that are decoded side by side.
SIDE_BY_SIDE = 1024
#: Documents that the tagger is trained on (those with the smallest hashes of their ids), the
#: excerpts taken from each around its data and with made-up data, and their length.
TRAIN_DOCS, PER_DOC, MADE_UP, EXCERPT = 1500, 3, 2, 96
HIDDEN = 20
MIN_SCORE = 0.0

# -- patterns ----------------------------------------------------------------

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def pattern_spans(text: str) -> list[tuple[str, int, int]]:
    """The fixed patterns' spans, by kind in the order of KINDS, then by start."""
    out = []
    at, done = text.find("@"), 0
    while at >= 0:                                        # the first @ with a name before it is the leftmost match
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        host = _DOMAIN.match(text, at + 1) if start < at else None
        if host:
            out.append(("email", start, host.end()))
            done = host.end()
        at = text.find("@", max(at + 1, done))
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(int(p[-9:]) <= 255 and not p[:-9].strip("0") for p in m.groups())]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


#: Forms that training data is rewritten to (tests hold others against the tagger): what stands for
#: the @ and the dots of an address, between the parts of an ip, of a card and of a phone, and how phones are set.
AT_FORMS = (" at ", " (at) ", "(at)", "[at]", " [at] ", " @ ", " AT ", "<at>", "-at-")
DOT_FORMS = (" dot ", "(dot)", "[dot]", " [dot] ", "[.]", "(.)", ".", " . ", " DOT ", "<dot>", "-dot-")
IP_FORMS = ("[.]", " . ", "(.)", " dot ", "(dot)", ", ", " .", "<.>")
CARD_FORMS = ("/", ".", ". ", "  ", " / ", ":", "--")
PHONE_FORMS = ("({a}) {b}{s}{c}", "{a}{s}{b}{s}{c}", "00{n}{s}{a}{s}{b}{s}{c}", "{a}{s}{b} {c}", "1{s}{a}{s}{b}{s}{c}", "({a}){b}{s}{c}")
PHONE_SIGNS = ("-", " ", ".", ". ", "/", "--")
ODD_SIGNS = "!#$%&*;=?^~"


def rewrite(kind: str, span: str, rng: np.random.Generator) -> str:
    """The same datum in a form that the patterns do not cover."""
    def of(forms):
        return forms[int(rng.integers(0, len(forms)))]

    def sign(forms):                                      # now and then any sign, so that none must be known
        if rng.random() < 0.6:
            return of(forms)
        return f"{' ' * int(rng.integers(0, 2))}{of(ODD_SIGNS)}{' ' * int(rng.integers(0, 2))}"
    digits = _digits(span)
    if kind == "email":
        name, _, host = span.partition("@")
        dot = of(DOT_FORMS)
        at = of(AT_FORMS) if dot == "." or rng.random() < 0.85 else "@"
        return f"{name}{at}{host.replace('.', dot)}"
    if kind == "ip":
        return span.replace(".", sign(IP_FORMS))
    if kind == "card":
        return sign(CARD_FORMS).join(digits[i:i + 4] for i in range(0, len(digits), 4))
    tail = digits[-10:].rjust(10, "2")
    return of(PHONE_FORMS).format(a=tail[:3], b=tail[3:6], c=tail[6:], n=digits[:-10] or "1", s=sign(PHONE_SIGNS))


def invented(kind: str, rng: np.random.Generator) -> str:
    """A made-up datum in the plain form, for documents that have none."""
    def digits(n):
        return "".join(map(str, rng.integers(0, 10, n)))

    def word():
        return "".join(rng.choice(list("abcdefghijklmnoprstuvw"), int(rng.integers(2, 9))))
    if kind == "email":
        return f"{word()}{rng.choice(['', '.' + word(), '_' + word(), digits(2)])}@{'.'.join(word() for _ in range(int(rng.integers(2, 4))))}"
    if kind == "ip":
        return ".".join(str(x >> s) for x, s in zip(rng.integers(0, 256, 4).tolist(), rng.integers(0, 7, 4).tolist(), strict=True))
    if kind == "card":
        body = digits(15)
        return next(body + str(d) for d in range(10) if luhn(body + str(d)))
    return f"+{rng.integers(1, 99)} {digits(3)} {digits(3)} {digits(4)}"


_AT = r"(?:[@\uff20]|(?<![A-Za-z])(?:at|AT|At)(?![A-Za-z]))"
_DOT = r"(?:\.(?=[A-Za-z0-9])|\s\.\s|[\[({<]\s*\.\s*[\])}>]|(?<![A-Za-z])(?:dot|DOT|Dot)(?![A-Za-z]))"
_ADDRESS = re.compile(rf"[A-Za-z0-9][\W_]*{_AT}[\W_]*[A-Za-z0-9][A-Za-z0-9-]*[\W_]*?{_DOT}[\W_]*[A-Za-z0-9]")
_FOUR_DIGITS = re.compile("[0-9][^0-9]*[0-9][^0-9]*[0-9][^0-9]*[0-9]")


def plausible(kind: str, span: str) -> bool:
    """Whether a span holds what its kind needs."""
    if kind == "email":
        return bool(_ADDRESS.search(span))
    bare = re.sub("(?i)dot", "", span) if kind == "ip" else span
    groups, n = re.findall(r"[0-9]+", bare), len(_digits(bare))
    if re.search("[A-Za-z]", bare):
        return False
    if kind == "ip":
        return len(groups) == 4 and all(int(g[-9:]) <= 255 for g in groups)
    if kind == "card":
        return 16 <= n <= 19 and len(groups) > 1 and luhn(_digits(bare))
    return 10 <= n <= 15 and len(groups) >= 3


def may_hold(text: str) -> bool:
    """False if no span of ``text`` can be plausible: no address, and fewer than four digits."""
    return bool(_FOUR_DIGITS.search(text) or _ADDRESS.search(text))


# -- the tagger -----------------------------------------------------------------

TAGS = len(KINDS) + 1
#: Code points by value up to U+007E, the rest in three codes; 0 is the padding after a text. Digits are
#: one code, letters are lower case, and signs of like use are one, so that none must have been seen.
_LIKE = str.maketrans("0123456789{<}>#$%&*=^~|_\\", "0000000000[[]]///////////")
_CODES = np.array([ord(chr(c).lower().translate(_LIKE)) - 30 if 32 <= c < 127 else 1 if c < 32 else 98 if 0xC0 <= c < 0x250
                   else 99 if c < 0xC0 else 100 for c in range(0x251)], np.uint8)
VOCABULARY = 101


def codes_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return _CODES[np.minimum(points, 0x250)]


def _soft(x):
    return x / (1 + np.abs(x))


def _soft_slope(x):
    return 1 / (1 + np.abs(x)) ** 2


@dataclass
class Tagger:
    """Parameters. ``u``: input table (codes to gates), ``v``: recurrent weights, ``e``: emissions,
    each for both directions; ``b``: tag bias, ``t``: transitions, ``s``: start scores. The gates
    are input, forget, output (0 to 1) and candidate (-1 to 1), all by x / (1 + |x|)."""
    u: np.ndarray                                         # (2, 4H, V)
    v: np.ndarray                                         # (2, 4H, H)
    e: np.ndarray                                         # (2, K, H)
    b: np.ndarray                                         # (K)
    t: np.ndarray                                         # (K, K) from, to
    s: np.ndarray                                         # (K)

    @classmethod
    def new(cls, hidden: int = HIDDEN, seed: int = 0) -> Tagger:
        r = np.random.default_rng(seed)
        u = r.normal(0, 0.3, (2, 4 * hidden, VOCABULARY))
        u[:, hidden:2 * hidden] += 1                      # remember at first
        return cls(u, r.normal(0, 0.3, (2, 4 * hidden, hidden)), r.normal(0, 0.3, (2, TAGS, hidden)),
                   np.zeros(TAGS), np.eye(TAGS) * 2, np.zeros(TAGS))

    def emissions(self, codes: np.ndarray, trace: list | None = None) -> np.ndarray:
        """Tag scores (T, K, B) of codes (T, B); padding (0) leaves the state unchanged at zero."""
        steps, wide = codes.shape
        h4, h = self.v.shape[1], self.v.shape[2]
        out = np.empty((steps, TAGS, wide), self.u.dtype)
        out[:] = self.b[:, None]
        for d in (0, 1):
            u, v, e = self.u[d], self.v[d], self.e[d]
            hid = np.zeros((h, wide), u.dtype)
            cell = np.zeros((h, wide), u.dtype)
            a, g, m = (np.empty((h4, wide), u.dtype) for _ in range(3))
            for t in (range(steps) if d == 0 else range(steps - 1, -1, -1)):
                np.matmul(v, hid, out=a)
                a += u.take(codes[t], axis=1)
                np.abs(a, out=m)
                m += 1
                np.divide(a, m, out=g)
                gates = g[:3 * h]
                gates += 1
                gates *= 0.5
                new = g[h:2 * h] * cell
                new += g[:h] * g[3 * h:]
                live = codes[t] != 0
                if not live.all():
                    new *= live
                squashed = new / (1 + np.abs(new))
                if trace is not None:
                    trace.append((d, t, a.copy(), g.copy(), hid, cell, new, squashed, live))
                cell = new
                hid = g[2 * h:3 * h] * squashed
                out[t] += e @ hid
        return out

    def decode(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags (T, B), and by how much each emission beats no tag (T, B)."""
        em = self.emissions(codes)
        steps, _, wide = em.shape
        score = em[0] + self.s[:, None].astype(em.dtype)
        back = np.zeros((steps, TAGS, wide), np.uint8)
        trans = self.t.astype(em.dtype)
        final = score.copy()
        for t in range(1, steps):
            new = np.empty_like(score)
            for j in range(TAGS):
                best = score[0] + trans[0, j]
                arg = back[t, j]
                for i in range(1, TAGS):
                    other = score[i] + trans[i, j]
                    arg[other > best] = i
                    np.maximum(best, other, out=best)
                new[j] = best
            new += em[t]
            score = new
            ended = lengths == t + 1
            if ended.any():
                final[:, ended] = score[:, ended]
        tags = np.zeros((steps, wide), np.uint8)
        at = final.argmax(axis=0)
        cols = np.arange(wide)
        for t in range(steps - 1, -1, -1):
            inside = t < lengths
            tags[t] = np.where(inside, at, 0)
            at = np.where(inside & (t > 0), back[t, at, cols], at)
        gain = np.take_along_axis(em, tags[:, None].astype(np.int64), axis=1)[:, 0] - em[:, 0]
        return tags, gain


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def gradients(model: Tagger, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
    """Negative log likelihood of full-length sequences (T, B), and its gradients."""
    steps, wide = codes.shape
    trace: list = []
    em = model.emissions(codes, trace)
    trans = model.t[:, :, None]
    alpha, beta = np.empty_like(em), np.zeros_like(em)
    alpha[0] = em[0] + model.s[:, None]
    for t in range(1, steps):
        alpha[t] = _log_sum(alpha[t - 1][:, None] + trans, 0) + em[t]
    for t in range(steps - 2, -1, -1):
        beta[t] = _log_sum(trans + (em[t + 1] + beta[t + 1])[None], 1)
    total = _log_sum(alpha[-1], 0)
    cols = np.arange(wide)
    gold = model.s[tags[0]] + em[0][tags[0], cols]
    g_em = np.exp(alpha + beta - total)
    grad = {"s": g_em[0].sum(axis=1), "t": np.zeros_like(model.t)}
    np.add.at(grad["s"], tags[0], -1.0)
    for t in range(1, steps):
        gold = gold + model.t[tags[t - 1], tags[t]] + em[t][tags[t], cols]
        pair = np.exp(alpha[t - 1][:, None] + trans + (em[t] + beta[t])[None] - total)
        grad["t"] += pair.sum(axis=2)
        np.add.at(grad["t"], (tags[t - 1], tags[t]), -1.0)
    for t in range(steps):
        g_em[t][tags[t], cols] -= 1
    grad |= {"b": g_em.sum(axis=(0, 2)), "u": np.zeros_like(model.u), "v": np.zeros_like(model.v), "e": np.zeros_like(model.e)}
    h = model.v.shape[2]
    carried = {0: None, 1: None}
    inputs = np.empty((2, steps, wide, 4 * h), model.u.dtype)
    for d, t, a, g, hid0, cell0, cell, squashed, live in reversed(trace):
        g_hid, g_cell = carried[d] or (np.zeros((h, wide), em.dtype), np.zeros((h, wide), em.dtype))
        hid = g[2 * h:3 * h] * squashed
        grad["e"][d] += g_em[t] @ hid.T
        g_hid = g_hid + model.e[d].T @ g_em[t]
        g_cell = g_cell + g_hid * g[2 * h:3 * h] * _soft_slope(cell)
        g_cell = g_cell * live
        g_gates = np.concatenate([g_cell * g[3 * h:], g_cell * cell0, g_hid * squashed, g_cell * g[:h]])
        g_gates[:3 * h] *= 0.5
        g_a = g_gates * _soft_slope(a)
        grad["v"][d] += g_a @ hid0.T
        inputs[d, t] = g_a.T
        carried[d] = (model.v[d].T @ g_a, g_cell * g[h:2 * h])
    seen = (codes.ravel()[:, None] == np.arange(VOCABULARY)).astype(model.u.dtype)
    for d in (0, 1):
        grad["u"][d] += inputs[d].reshape(-1, 4 * h).T @ seen
    return float((total - gold).sum()), grad


def train(examples: list[tuple[str, list[tuple[str, int, int]]]], passes: int = 12, batch: int = 96,
          rate: float = 0.02, seed: int = 0) -> Tagger | None:
    """Fit on excerpts of EXCERPT characters with their spans (Adam); None without a span."""
    if not any(spans for _, spans in examples):
        return None
    codes = np.zeros((len(examples), EXCERPT), np.uint8)
    tags = np.zeros((len(examples), EXCERPT), np.int64)
    for i, (text, spans) in enumerate(examples):
        text = text[:EXCERPT].ljust(EXCERPT)
        codes[i] = codes_of(text)
        for kind, a, b in spans:
            tags[i, a:b] = 1 + KINDS.index(kind)
    model, rng = Tagger.new(seed=seed), np.random.default_rng(seed)
    names = ("u", "v", "e", "b", "t", "s")
    for k in names:
        setattr(model, k, getattr(model, k).astype(np.float32))
    mean = {k: np.zeros_like(getattr(model, k)) for k in names}
    square = {k: np.zeros_like(getattr(model, k)) for k in names}
    step = 0
    rounds = passes * -(-len(examples) // batch)
    for _ in range(passes):
        order = rng.permutation(len(examples))
        for lo in range(0, len(order), batch):
            pick = order[lo:lo + batch]
            _, grad = gradients(model, codes[pick].T, tags[pick].T)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values())) / len(pick)
            step += 1
            pace = rate * max(0.05, 1 - step / rounds)
            for k in names:
                g = grad[k] / len(pick) * min(1.0, 5.0 / max(norm, 1e-9))
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g * g
                getattr(model, k)[...] -= pace * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-6)
    return model


# -- whole texts ------------------------------------------------------------------

def _decoded(model: Tagger, codes: list, cuts: list) -> Iterator[tuple]:
    """(cut, [(tag, start, end, score)]) of windows (text number, start, end), SIDE_BY_SIDE at a time."""
    cuts = sorted(cuts, key=lambda x: x[2] - x[1])
    for at in range(0, len(cuts), SIDE_BY_SIDE):
        part = cuts[at:at + SIDE_BY_SIDE]
        lengths = np.array([b - a for _, a, b in part])
        table = np.zeros((len(part), int(lengths[-1])), np.uint8)
        for row, (i, a, b) in enumerate(part):
            table[row, :b - a] = codes[i][a:b]
        tags, gain = model.decode(np.ascontiguousarray(table.T), lengths)
        for col in np.flatnonzero(tags.any(axis=0)).tolist():
            _, a, b = part[col]
            line = tags[:b - a, col]
            edge = np.flatnonzero(np.diff(np.r_[0, line, 0]))
            yield part[col], [(int(line[s]), a + int(s), a + int(e), float(gain[s:e, col].sum()))
                              for s, e in zip(edge, edge[1:], strict=False) if line[s]]


def tagger_spans(model: Tagger, texts: list[str]) -> list[list[tuple[str, int, int, float]]]:
    """(kind, start, end, score) that the tagger finds in every text, without overlaps."""
    found: list[list] = [[] for _ in texts]
    codes = [codes_of(t) for t in texts]
    cuts = [(i, lo, min(lo + WINDOW, len(t))) for i, t in enumerate(texts)
            for lo in range(0, max(1, len(t) - OVERLAP), WINDOW - OVERLAP) if may_hold(t[lo:lo + WINDOW])]
    wide = WINDOW
    while cuts:
        broken = []
        for (i, a, b), spans in _decoded(model, codes, cuts):
            for tag, s, e, score in spans:
                if (a > 0 and s - a < MARGIN) or (b < len(codes[i]) and b - e < MARGIN):
                    broken.append((i, s, e))              # cut off by the window's edge, or seen without what follows
                else:
                    found[i].append((KINDS[tag - 1], s, e, score))
        if wide == WINDOW:                                # neighbours that disagree see too little of a datum
            broken += [(i, min(x[1], y[1]), max(x[2], y[2])) for i, spans in enumerate(found)
                       for own in [sorted(set(spans), key=lambda x: x[1:3])]
                       for x, y in zip(own, own[1:], strict=False) if y[1] < x[2]]
        # unless another window has the whole, a wider one around it is decoded
        wide *= 2
        cuts = list({(i, max(0, (s + e - wide) // 2), min(len(codes[i]), (s + e + wide) // 2)) for i, s, e in broken
                     if not any(f[1] <= s and e <= f[2] for f in found[i])})
    out = []
    for spans in found:
        kept: list = []
        for span in sorted(set(spans), key=lambda x: (-x[3], x[1], x[2])):
            if all(span[2] <= k[1] or span[1] >= k[2] for k in kept):
                kept.append(span)
        out.append(sorted(kept, key=lambda x: x[1]))
    return out


def trim(text: str, kind: str, start: int, end: int) -> tuple[int, int]:
    """The span without spaces and punctuation around it (an opening bracket or plus may begin one)."""
    while start < end and not (text[start].isalnum() or text[start] in "+("):
        start += 1
    while end > start and not text[end - 1].isalnum():
        end -= 1
    return start, end


def all_spans(model: Tagger | None, texts: list[str | None]) -> tuple[list, list]:
    """(pattern spans, all spans) of every text, by kind in the order of KINDS, then by start."""
    base = [pattern_spans(t or "") for t in texts]
    every = [list(b) for b in base]
    if model is not None:
        for text, spans, own in zip(texts, every, tagger_spans(model, [t or "" for t in texts]), strict=True):
            for kind, a, b, score in own:
                a, b = trim(text, kind, a, b)
                if (score >= MIN_SCORE and plausible(kind, text[a:b])
                        and all(b <= s or a >= e for _, s, e in spans)):
                    spans.append((kind, a, b))
    for spans in every:
        spans.sort(key=lambda x: (KINDS.index(x[0]), x[1]))
    return base, every


def excerpts(text: str | None, seed: int) -> list[tuple[str, list]]:
    """Training excerpts of a text: at most PER_DOC around pattern spans, as they are or rewritten,
    MADE_UP with a made-up datum, and one without any, around digits or an "at" if there is one."""
    text = text or ""
    rng = np.random.default_rng(seed)
    spans = sorted(pattern_spans(text), key=lambda x: x[1])
    spans = [s for k, s in enumerate(spans) if not k or s[1] >= spans[k - 1][2]]
    out = []

    def add(kind, word, before, after):
        if len(word) <= EXCERPT * 3 // 4:
            before = before[len(before) - int(rng.integers(0, EXCERPT - len(word) + 1)):] if before else ""
            before = before[-(EXCERPT - len(word)):] if len(word) < EXCERPT else ""
            out.append(((before + word + after)[:EXCERPT], [(kind, len(before), len(before) + len(word))]))
    for k in rng.permutation(len(spans))[:PER_DOC].tolist():
        kind, a, b = spans[k]
        word = text[a:b] if rng.random() < 0.25 else rewrite(kind, text[a:b], rng)
        add(kind, word, text[max(spans[k - 1][2] if k else 0, a - EXCERPT):a],
            text[b:spans[k + 1][1] if k + 1 < len(spans) else len(text)][:EXCERPT])

    def clean(at):
        lo = max(0, at - EXCERPT // 2)
        return None if any(s < lo + EXCERPT and e > lo for _, s, e in spans) else text[lo:lo + EXCERPT]
    for kind in (KINDS[k] for k in rng.permutation(len(KINDS))[:MADE_UP]):
        spot = clean(int(rng.integers(0, max(1, len(text) - EXCERPT))))
        if spot is None:
            continue
        word = invented(kind, rng)
        at = spot.find(" ", int(rng.integers(0, EXCERPT)))
        add(kind, rewrite(kind, word, rng) if rng.random() < 0.85 else word, spot[:at + 1], " " + spot[at + 1:])
    telling = [m.start() for m in re.finditer(r"[0-9]|(?i:\bat\b|\bdot\b)", text)]
    none = clean(telling[int(rng.integers(0, len(telling)))] if telling and rng.random() < 0.8
                 else int(rng.integers(0, max(1, len(text)))))
    if none:
        out.append((none, []))
    return out


def fit_tagger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_DOCS) -> Tagger | None:
    """Train on excerpts of at most ``rows`` documents; half of them hold digits or an @."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).filter("id is not null and text is not null")
    telling = F.col("text").rlike("[0-9@]")

    def pick(some: DataFrame, n: int) -> DataFrame:
        return some.select("id").orderBy(F.xxhash64("id", F.lit(11)), "id").limit(n)
    sample = pick(own.filter(telling), rows - rows // 2).union(pick(own.filter(~telling), rows // 2)).distinct()

    def make():
        def run(texts):
            found = [excerpts(t, len(t)) for t in texts]
            return {"text": [[x for x, _ in f] for f in found],
                    "spans": [[";".join(f"{k}:{a}:{b}" for k, a, b in s) for _, s in f] for f in found]}
        return run
    # at most ``rows`` ids are broadcast; a few short excerpts of each document meet in one task, which sends back the tagger
    found = (own.join(F.broadcast(sample), "id")
             .select("id", per_text(F.col("text"), make, "text array<string>, spans array<string>").alias("x"))
             .groupBy("id").agg(F.max(F.struct("x.text", "x.spans")).alias("x")).select("id", "x.text", "x.spans"))

    def fit(held):
        examples = [(text, [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in spans.split(";") if s)])
                    for _, texts, marked in sorted(held, key=lambda r: r[0]) for text, spans in zip(texts, marked, strict=True)]
        model = train(examples)
        return model and [getattr(model, k) for k in "uvebts"]
    weights = fit_in_task(found, fit)
    return Tagger(*weights) if weights else None


def _joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_pii(docs: DataFrame, model: Tagger | None, text_col: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with a struct column ``out``: the number of pattern spans of each kind, ``base``
    (pattern spans) and ``spans`` (all spans), as kind:start:end, comma-joined."""
    def make():
        def run(texts):
            base, every = all_spans(model, texts)
            return {**{f"n_{k}": [sum(s[0] == k for s in b) for b in base] for k in KINDS},
                    "base": list(map(_joined, base)), "spans": list(map(_joined, every))}
        return run
    return docs.withColumn(out, per_text(F.col(text_col), make, ", ".join(f"n_{k} bigint" for k in KINDS)
                                         + ", base string, spans string"))


def redacted(text: Column, model: Tagger | None) -> Column:
    """The text with every span replaced by its kind in angle brackets; null stays null."""
    def make():
        def clean(t, spans):
            parts, at = [], 0
            for kind, a, b in sorted(spans, key=lambda x: (x[1], -x[2])):
                if b <= at:
                    continue
                parts += [t[at:max(at, a)], f"<{kind.upper()}>"] if a >= at else []
                at = b
            return "".join([*parts, t[at:]])

        def run(texts):
            every = all_spans(model, texts)[1]
            return {"text": [t if not s else clean(t, s) for t, s in zip(texts, every, strict=True)]}
        return run
    return per_text(text, make, "text string")["text"]
