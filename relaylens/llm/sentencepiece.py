"""SentencePiece encoding and decoding: Aho-Corasick over the pieces drives a
single-pass Viterbi.

The pieces and their scores come from a model file. The automaton reads a text
once; at every character it follows the output links of its state, longest
piece first, and each piece found there relaxes the best score that ends at
that character. A character without a one-character piece is an unknown step,
spelled in byte pieces. The path of the largest score sum wins, ties go to the
longer last piece. Scores are added in 64-bit floats.

Spaces become U+2581, and one is put in front. Where no piece of the model
continues over a boundary (a U+2581 after another character; a line feed) the
text is cut, which leaves the best path unchanged. Distinct chunks are solved
once and remembered over a worker's tasks: short ones side by side in numpy, one character of all of them
at a time, long ones alone.

Defined cases: a null text has null ids and decodes to null; an empty one has
none and decodes to the empty text. A U+2581 in a text decodes to a space, as
the format has no other reading. Repeated rows stay; other columns are kept.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept_in_worker, per_text, per_value

SPACE = "▁"
#: An unknown step scores this much less than the lowest piece.
UNKNOWN_PENALTY = 10.0
#: Longest chunk that is solved side by side with others.
SHORT = 40
#: Distinct chunks that a worker remembers.
HELD_CHUNKS = 200_000


@dataclass
class Automaton:
    """Trie edges in sorted arrays, failure links, and the pieces that end at every state
    (its own and those behind its output links), longest first."""
    letters: np.ndarray                                   # code points of the pieces, sorted
    edge: np.ndarray                                      # state * (letters + 1) + letter number, sorted
    target: np.ndarray
    fail: np.ndarray
    out_from: np.ndarray                                  # of state s: out_from[s] to out_from[s + 1]
    out_length: np.ndarray
    out_score: np.ndarray
    out_id: np.ndarray
    unknown: float
    byte_ids: np.ndarray | None                           # ids of the 256 byte pieces
    unknown_id: int
    cuts: str                                             # pattern of chunks that no piece leaves
    texts: list[bytes]                                    # bytes of every id when decoded

    @classmethod
    def build(cls, pieces: list[tuple[int, str, float]], texts: list[bytes], byte_ids=None, unknown_id: int = 0):
        """``pieces``: (id, piece, score) of the normal ones; of equal pieces the first counts."""
        letters = np.array(sorted({ord(c) for _, p, _ in pieces for c in p}), np.int64)
        number = {int(c): i + 1 for i, c in enumerate(letters)}
        children: list[dict[int, int]] = [{}]
        own: dict[int, tuple[int, float, int]] = {}
        for i, piece, score in pieces:
            s = 0
            for c in piece:
                k = number[ord(c)]
                if k not in children[s]:
                    children[s][k] = len(children)
                    children.append({})
                s = children[s][k]
            if piece:
                own.setdefault(s, (len(piece), score, i))
        fail, link = [0] * len(children), [0] * len(children)
        ends: list[list] = [[] for _ in children]
        queue = deque(children[0].values())
        order = []
        while queue:
            s = queue.popleft()
            order.append(s)
            for k, t in children[s].items():
                f = fail[s]
                while f and k not in children[f]:
                    f = fail[f]
                fail[t] = children[f].get(k, 0)
                queue.append(t)
        for s in order:                                   # output link: the nearest failure state with a piece
            f = fail[s]
            link[s] = f if f in own else link[f]
            ends[s] = ([own[s]] if s in own else []) + ends[link[s]]
        rows = sorted((s * (len(letters) + 1) + k, t) for s, c in enumerate(children) for k, t in c.items())
        flat = [e for x in ends for e in x]
        inner = any(a != SPACE and b == SPACE for _, p, _ in pieces for a, b in zip(p, p[1:], strict=False))
        feed = "" if ord("\n") in number else "\n"
        cuts = r"[\s\S]+" if inner else rf"{SPACE}*[^{SPACE}{feed}]+|{SPACE}+" + (r"|\n" if feed else "")
        return cls(letters, np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int32),
                   np.array(fail, np.int32), np.cumsum([0] + [len(x) for x in ends]).astype(np.int32),
                   np.array([e[0] for e in flat], np.int32), np.array([e[1] for e in flat], np.float64),
                   np.array([e[2] for e in flat], np.int32),
                   min((p[2] for p in pieces), default=0.0) - UNKNOWN_PENALTY,
                   byte_ids, unknown_id, cuts, texts)

    # -- many short chunks ------------------------------------------------------

    def _numbers(self, codes: np.ndarray) -> np.ndarray:
        """Letter numbers of code points, 0 for those of no piece."""
        at = np.minimum(np.searchsorted(self.letters, codes), max(0, len(self.letters) - 1))
        return np.where(self.letters[at] == codes, at + 1, 0) if len(self.letters) else np.zeros(len(codes), np.int64)

    def _step(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """Next states: along an edge, else from the failure state, down to the root."""
        out = np.zeros(len(state), np.int64)
        open_, s = np.flatnonzero(letter), state[letter != 0].astype(np.int64)
        while len(open_):
            key = s * (len(self.letters) + 1) + letter[open_]
            at = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
            found = self.edge[at] == key
            out[open_[found]] = self.target[at[found]]
            left = ~found & (s != 0)
            open_, s = open_[left], self.fail[s[left]].astype(np.int64)
        return out

    def solve(self, chunks: list[str]) -> list[bytes]:
        """Ids of the best path of every chunk (little-endian int32 bytes); chunks of similar
        length side by side."""
        done = [b""] * len(chunks)
        order = sorted(range(len(chunks)), key=list(map(len, chunks)).__getitem__)
        for lo in range(0, len(order), 8192):
            part = order[lo:lo + 8192]
            short = [i for i in part if len(chunks[i]) <= SHORT]
            for i, ids in zip(short, self._solve_block([chunks[i] for i in short]), strict=True):
                done[i] = ids
            for i in part[len(short):]:
                done[i] = self.solve_long(chunks[i])
        return done

    def _solve_block(self, chunks: list[str]) -> list[bytes]:
        if not chunks:
            return []
        size = np.array([len(c) for c in chunks], np.int64)
        wide, n = int(size.max()), len(chunks)
        codes = np.frombuffer("".join(c.ljust(wide, "\0") for c in chunks).encode("utf-32-le", "surrogatepass"), "<u4")
        codes = codes.astype(np.int64).reshape(n, wide)
        letter = self._numbers(codes.ravel()).reshape(n, wide)
        best = np.full((wide + 1, n), -np.inf)
        best[0] = 0
        back = np.ones((wide + 1, n), np.int64)           # length of the last piece, and its id (-1: unknown)
        last = np.full((wide + 1, n), -1, np.int64)
        state = np.zeros(n, np.int64)
        for t in range(1, wide + 1):
            state = self._step(state, letter[:, t - 1])
            first, count = self.out_from[state], self.out_from[state + 1] - self.out_from[state]
            one = np.zeros(n, bool)
            k = 0
            while len(rows := np.flatnonzero(count > k)):
                o = first[rows] + k
                length = self.out_length[o]
                score = best[t - length, rows] + self.out_score[o]
                better = score > best[t, rows]
                r, o = rows[better], o[better]
                best[t, r], back[t, r], last[t, r] = score[better], length[better], self.out_id[o]
                one[rows[length == 1]] = True
                k += 1
            score = best[t - 1] + self.unknown
            r = np.flatnonzero(~one & (score > best[t]))
            best[t, r], back[t, r], last[t, r] = score[r], 1, -1
        at, live = size.copy(), np.flatnonzero(size > 0)
        none = np.zeros(0, np.int64)
        found_row, found_id, found_at = [none], [none], [none]
        while len(live):
            pos = at[live]
            found_row.append(live)
            found_id.append(last[pos, live])
            found_at.append(pos)
            at[live] = pos - back[pos, live]
            live = live[at[live] > 0]
        row, ident, pos = (np.concatenate(x) for x in (found_row, found_id, found_at))
        order = np.lexsort((pos, row))
        row, ident, pos = row[order], ident[order], pos[order]
        cuts = np.r_[0, np.cumsum(np.bincount(row, minlength=n))].tolist()
        data = ident.astype("<i4").tobytes()
        paths = [data[4 * a:4 * b] for a, b in zip(cuts, cuts[1:], strict=False)]
        for i in np.unique(row[ident < 0]).tolist():      # chunks with unknown characters
            a, b = cuts[i], cuts[i + 1]
            paths[i] = self._spelled(chunks[i], ident[a:b].tolist(), pos[a:b].tolist())
        return paths

    def _spelled(self, chunk: str, ids: list[int], ends: list[int]) -> bytes:
        """The path's ids, unknown steps (-1) spelled out."""
        out = [j for i, e in zip(ids, ends, strict=True) for j in ([i] if i >= 0 else self.spell(chunk[e - 1]))]
        return np.array(out, "<i4").tobytes()

    # -- one long chunk -----------------------------------------------------------

    @cached_property
    def _table(self) -> dict[int, int]:
        return dict(zip(self.edge.tolist(), self.target.tolist(), strict=True))

    @cached_property
    def _ends(self) -> list:
        return [list(zip(self.out_length[a:b].tolist(), self.out_score[a:b].tolist(), self.out_id[a:b].tolist(),
                         strict=True)) for a, b in zip(self.out_from[:-1].tolist(), self.out_from[1:].tolist(), strict=True)]

    def solve_long(self, chunk: str) -> bytes:
        width, table, ends, fail = len(self.letters) + 1, self._table, self._ends, self.fail
        codes = np.frombuffer(chunk.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        best, back, last, s = [0.0], [0], [-1], 0
        for t, k in enumerate(self._numbers(codes).tolist(), 1):
            if k:
                while (to := table.get(s * width + k)) is None and s:
                    s = int(fail[s])
                s = to or 0
            else:
                s = 0
            top, length, ident, one = -np.inf, 1, -1, False
            for n, score, i in ends[s]:
                if best[t - n] + score > top:
                    top, length, ident = best[t - n] + score, n, i
                one = one or n == 1
            if not one and best[t - 1] + self.unknown > top:
                top, length, ident = best[t - 1] + self.unknown, 1, -1
            best.append(top)
            back.append(length)
            last.append(ident)
        t, ids, stops = len(chunk), [], []
        while t:
            ids.append(last[t])
            stops.append(t)
            t -= back[t]
        return self._spelled(chunk, ids[::-1], stops[::-1])

    # -- texts --------------------------------------------------------------------

    def spell(self, char: str) -> list[int]:
        """Ids of an unknown character."""
        if self.byte_ids is None:
            return [self.unknown_id]
        return self.byte_ids[list(char.encode("utf-8", "surrogatepass"))].tolist()

    def encoder(self):
        """Function from a list of texts to an Arrow array of their ids; it remembers chunks."""
        known: dict[str, bytes] = {}
        split = re.compile(self.cuts).findall

        def encode(texts: Iterable[str | None]) -> pa.ListArray:
            parts = [split(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
            if len(known) > HELD_CHUNKS:
                known.clear()
            new = list({c for p in parts for c in p if c not in known})
            known.update(zip(new, self.solve(new), strict=True))
            coded = [b"".join(map(known.__getitem__, p)) for p in parts]
            ends = np.cumsum([0] + [len(c) // 4 for c in coded])
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(coded), "<i4")),
                                            mask=pa.array([t is None for t in texts]))
        return encode

    def decode(self, ids: Iterable[int] | None) -> str | None:
        if ids is None:
            return None
        text = b"".join(map(self.texts.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


def load_model(path: str) -> Automaton:
    """Automaton of a SentencePiece model file."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces, texts, of_byte = [], [], {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            of_byte[int(piece[3:5], 16)] = i
            texts.append(bytes([int(piece[3:5], 16)]))
        elif model.is_unknown(i) or model.is_control(i) or model.is_unused(i):
            texts.append(b"")
        else:
            pieces.append((i, piece, model.get_score(i)))
            texts.append(piece.encode())
    byte_ids = np.array([of_byte[b] for b in range(256)]) if len(of_byte) == 256 else None
    return Automaton.build(pieces, texts, byte_ids, max(0, model.unk_id()))


def share_model(spark: SparkSession, path: str):
    """The automaton's fields for every task (plain arrays, so that executors need no copy of
    this module): their size is set by the vocabulary alone."""
    return spark.sparkContext.broadcast((path, dict(vars(load_model(path)))))


def _automaton(model) -> tuple[Automaton, Callable]:
    """The shared automaton and its encoder, as a worker keeps them."""
    path, fields = model.value

    def make():
        own = Automaton(**fields)
        return own, own.encoder()
    return kept_in_worker(("pieces", path), make)


def encode(docs: DataFrame, model, text_col: str = "text", out: str = "pieces") -> DataFrame:
    """``docs`` with the ids of ``text_col`` (array<int>) in column ``out``; ``model`` from share_model."""
    def make():
        run = _automaton(model)[1]
        return lambda texts: {"ids": run(texts)}
    return docs.withColumn(out, per_text(F.col(text_col), make, "ids array<int>")["ids"])


def decode(docs: DataFrame, model, ids_col: str = "pieces", out: str = "decoded") -> DataFrame:
    """``docs`` with the text of ``ids_col`` in column ``out``."""
    def make():
        read = _automaton(model)[0].decode

        def run(rows: pa.ListArray):
            ids, ends = rows.values.to_numpy().tolist(), rows.offsets.to_pylist()
            return {"text": [None if null else read(ids[a:b]) for a, b, null in
                             zip(ends, ends[1:], rows.is_null().to_pylist(), strict=False)]}
        return run
    return docs.withColumn(out, per_value(F.col(ids_col), make, "text string")["text"])


def round_trip(docs: DataFrame, model, text_col: str = "text", pieces: str = "pieces", decoded: str = "decoded") -> DataFrame:
    """As ``encode`` then ``decode``, in one pass and so in one Python worker a task."""
    def make():
        own, run = _automaton(model)

        def both(texts):
            ids = run(texts)
            flat, ends = ids.values.to_numpy(), ids.offsets.to_pylist()
            return {"ids": ids, "text": [None if t is None else own.decode(flat[a:b].tolist())
                                         for t, a, b in zip(texts, ends, ends[1:], strict=False)]}
        return both
    done = docs.withColumn(decoded, per_text(F.col(text_col), make, "ids array<int>, text string"))
    return done.withColumn(pieces, F.col(f"{decoded}.ids")).withColumn(decoded, F.col(f"{decoded}.text"))
