"""Token ids in ascending document order, stored in Simple-8b coding.

A segment codes the ids of consecutive documents in 64-bit words: the top four
bits are a selector, the other 60 hold as many ids of one bit width as fit
(``SELECTORS``). An id of more than 60 bits is an escape: a pair of words with
selector 0 that hold its upper and lower 32 bits. Ids are coded in blocks of
``BLOCK`` ids that start on a word, and a segment lists the first word of every
block, so any block decodes alone and all words of one selector decode in one
numpy step.

Segment bytes (little endian): ``S8B1``, uint32 block size, uint64 ids,
uint32 blocks + 1 offsets, then the words.

The written table is a folder of Parquet files, one or more per range of ids,
whose rows are segments: ``part`` and ``seg`` (their order), ``before`` (ids of
the part before them), ``n_ids``, ``doc_ids``, ``counts`` and ``payload``. Spark's committer writes it, so retried tasks
leave no partial files.

Defined cases: a null text is an empty one and has only the end id. Null ids
come first. Rows with equal ids are ordered by a hash of their text, and each
keeps its own row. An empty table writes no segments and reads back as no
rows. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: selector -> (bits, ids); 0 is the escape.
SELECTORS = {1: (1, 60), 2: (2, 30), 3: (3, 20), 4: (4, 15), 5: (5, 12), 6: (6, 10), 7: (7, 8), 8: (8, 7),
             9: (10, 6), 10: (12, 5), 11: (15, 4), 12: (20, 3), 13: (30, 2), 14: (60, 1)}
BLOCK = 1024
#: Ids in a segment, unless one document has more.
SEGMENT_IDS = 1 << 19
#: Bytes of text in a range of ids.
RANGE_BYTES = 16 << 20
#: Pieces of words that an encoder remembers, and as many words that are not cut.
HELD_WORDS = 600_000
#: Bytes of text that an encoder gets at a time, unless one document has more.
GROUP_BYTES = 4 << 20
#: Words of a text whose ids are put together at a time.
GROUP_WORDS = 1 << 18
MAGIC = b"S8B1"


def pack(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """The ids (unsigned) as one segment."""
    ids = np.asarray(ids, np.uint64)
    n = len(ids)
    if not n:
        return MAGIC + np.array([block], "<u4").tobytes() + np.zeros(1, "<u8").tobytes() + np.zeros(1, "<u4").tobytes()
    blocks = -(-n // block)
    row = block + 64                                      # zeros after a block: the padding of its last word
    table = np.zeros((blocks, row), np.uint64)
    full = n // block
    table[:full, :block] = ids[:full * block].reshape(full, block)
    table[full:, :n - full * block] = ids[full * block:]
    level = np.zeros(table.shape, np.uint8)               # the first bit width that holds the id, 14: none
    for bits, _ in SELECTORS.values():
        level += table >> np.uint64(bits) != 0
    highest = {1: level}                                  # of so many ids from a place on
    while (m := max(highest)) < 32:
        wider = highest[m].copy()
        np.maximum(wider[:, :-m], highest[m][:, m:], out=wider[:, :-m])
        highest[2 * m] = wider
    selector = np.zeros(table.shape, np.uint8)
    for s in sorted(SELECTORS, reverse=True):             # the fullest word that fits comes last
        count = SELECTORS[s][1]
        m = 1 << (count.bit_length() - 1)
        top = highest[m].copy()
        if count > m:
            np.maximum(top[:, :m - count], highest[m][:, count - m:], out=top[:, :m - count])
        selector[top < s] = s
    flat, chosen_of = table.reshape(-1), selector.reshape(-1)
    size = np.array([1] + [SELECTORS[s][1] for s in range(1, 15)], np.int64)
    pos = np.arange(blocks, dtype=np.int64) * row
    ends = pos + np.minimum(block, n - np.arange(blocks) * block)
    firsts, heads = pos, []
    while len(pos):                                       # all blocks advance by one word at a time
        heads.append(pos)
        pos = pos + size[chosen_of[pos]]
        live = pos < ends
        pos, ends = pos[live], ends[live]
    heads = np.sort(np.concatenate(heads))
    chosen = chosen_of[heads]
    width = np.where(chosen == 0, 2, 1)
    where = np.cumsum(width) - width
    words = np.zeros(int(width.sum()), np.uint64)
    for s in np.unique(chosen).tolist():
        pick = np.flatnonzero(chosen == s)
        first = heads[pick]
        if not s:
            words[where[pick]] = flat[first] >> np.uint64(32)
            words[where[pick] + 1] = flat[first] & np.uint64(0xFFFFFFFF)
            continue
        bits, count = SELECTORS[s]
        word = np.full(len(pick), s << 60, np.uint64)
        for j in range(count):
            word |= flat[first + j] << np.uint64(j * bits)
        words[where[pick]] = word
    offsets = np.r_[where[np.searchsorted(heads, firsts)], len(words)]
    return b"".join([MAGIC, np.array([block], "<u4").tobytes(), np.array([n], "<u8").tobytes(),
                     offsets.astype("<u4").tobytes(), words.astype("<u8").tobytes()])


def unpack(segment: bytes, first_block: int = 0, last_block: int | None = None) -> np.ndarray:
    """The ids (uint64) of a segment, or of a range of its blocks."""
    if segment[:4] != MAGIC:
        raise ValueError("not a Simple-8b segment")
    block = int(np.frombuffer(segment, "<u4", 1, 4)[0])
    n = int(np.frombuffer(segment, "<u8", 1, 8)[0])
    blocks = -(-n // block)
    offsets = np.frombuffer(segment, "<u4", blocks + 1, 16).astype(np.int64)
    last = blocks if last_block is None else min(last_block, blocks)
    if first_block >= last:
        return np.zeros(0, np.uint64)
    words = np.frombuffer(segment, "<u8", -1, 16 + 4 * (blocks + 1))[offsets[first_block]:offsets[last]]
    starts = offsets[first_block:last] - offsets[first_block]
    base = first_block * block
    total = min(n, last * block) - base
    selector = (words >> np.uint64(60)).astype(np.int64)
    count = np.array([0] + [SELECTORS[s][1] for s in range(1, 15)], np.int64)[selector]
    escapes = np.flatnonzero(selector == 0)               # pairs; the first word of a pair stands for the id
    count[escapes[::2]] = 1
    of_block = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(words)]))
    before = np.cumsum(count) - count                     # with the padding of blocks' last words
    at = before - before[starts][of_block] + of_block * block
    out = np.zeros(total + 64, np.uint64)
    for s in np.unique(selector).tolist():
        if not s:
            out[at[escapes[::2]]] = words[escapes[::2]] << np.uint64(32) | words[escapes[1::2]]
            continue
        bits, size = SELECTORS[s]
        pick = np.flatnonzero(selector == s)
        limit = np.minimum((of_block[pick] + 1) * block, total)
        mask = np.uint64((1 << bits) - 1)
        for j in range(size):
            inside = at[pick] + j < limit
            out[at[pick][inside] + j] = words[pick][inside] >> np.uint64(j * bits) & mask
    return out[:total]


class _Held(dict):
    """Words or pieces of words with their ids (little-endian uint32 bytes), encoded when first met."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode

    def __missing__(self, key: str) -> bytes:
        ids = self[key] = self.encode(key)
        return ids

    def lists(self, keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all keys, one after the other, and how many each key has."""
        if len(self) > HELD_WORDS:
            self.clear()
        coded = list(map(self.__getitem__, keys.to_numpy(zero_copy_only=False).tolist()))
        return np.frombuffer(b"".join(coded), "<u4"), np.fromiter(map(len, coded), np.int64, len(coded)) // 4


def _take(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The lists ``of`` these numbers, one after the other; list k is ``sizes[k]`` ids from ``starts[k]`` on."""
    n = sizes[of]
    return ids[np.repeat(starts[of] - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def word_encoder(path: str) -> WordEncoder:
    """Encoder of whole texts with the ``tokenizers`` file at ``path``, without special tokens."""
    return WordEncoder(path)


class WordEncoder:
    """Whole texts to ids (little-endian uint32 bytes), one text a call or an Arrow array of texts (``many``).

    The file's split never joins characters across white space, so the words of an array are told apart in
    Arrow and each different one is encoded once; a text is the sequence of its words' ids.

    Words of ASCII and Latin letters that the file's normalizer only turns to lower case are cut by the file's
    own pattern, all in one pass, and each different piece goes to the file's model. Any other word goes
    through the whole tokenizer. Pieces and such words are remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.chars = _byte_chars()
        # letters with one letter as lower case; none of them, nor ASCII, changes under NFC
        latin = "".join(c for c in map(chr, range(0xC0, 0x180)) if c.isalpha() and len(c.lower()) == 1)
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = "|".join([f"[^!-~{latin}]", *added])
        # the file's pattern on lower case of the other words, whose characters beyond ASCII are letters; a line is a word
        self.cut = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\x80-\uffff]+|[0-9]|\n|[^a-z0-9\n\x80-\uffff]+").findall
        self.pieces, self.words = _Held(self._encode_piece), _Held(self._encode_word)

    def __call__(self, text: str) -> bytes:
        return self.many(pa.array([text], pa.string()))[0]

    def many(self, texts: pa.Array) -> list[bytes]:
        split = pc.ascii_split_whitespace(texts)              # an end of white space gives an empty word, without ids
        coded = split.flatten().dictionary_encode()
        lists, of = self._lists(coded.dictionary), coded.indices.to_numpy()
        data = b"".join(_take(*lists, of[lo:lo + GROUP_WORDS]).tobytes() for lo in range(0, len(of), GROUP_WORDS))
        ends = 4 * np.r_[0, np.cumsum(lists[2][of])][split.offsets.to_numpy()]
        return [data[a:b] for a, b in pairwise(ends.tolist())]

    def _lists(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where those of every word start and how many they are."""
        odd = pc.match_substring_regex(words, self.odd)
        lines = "".join(w + "\n" for w in words.filter(pc.invert(odd)).to_numpy(zero_copy_only=False).tolist()).lower()
        cut = pa.array(self.cut(lines), pa.string()).dictionary_encode()
        of, line_end = cut.indices.to_numpy(), pc.index(cut.dictionary, "\n").as_py()
        ids, sizes = self.pieces.lists(cut.dictionary)
        line_ends = np.cumsum(sizes[of])[of == line_end]
        odd_ids, odd_sizes = self.words.lists(words.filter(odd))
        ids = np.r_[_take(ids, np.cumsum(sizes) - sizes, sizes, of), odd_ids]
        sizes = np.r_[np.diff(line_ends, prepend=0), odd_sizes]
        place = np.argsort(np.argsort(odd.to_numpy(zero_copy_only=False), kind="stable"))
        return ids, (np.cumsum(sizes) - sizes)[place], sizes[place]

    def _encode_piece(self, piece: str) -> bytes:
        if piece == "\n":
            return b""
        found = self.model.tokenize(piece if piece.isascii() else piece.translate(self.chars))
        return array("I", [t.id for t in found]).tobytes()

    def _encode_word(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()


def _byte_chars() -> dict[int, str]:
    """Latin letters to the visible characters that stand for their UTF-8 bytes in byte-level
    vocabularies: printable bytes are themselves, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    byte = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return {c: "".join(byte[b] for b in chr(c).encode()) for c in range(0xC0, 0x180)}


def write_tokens(docs: DataFrame, path: str, encoder: Callable[[], Callable[[str], bytes]], end_id: int = 2,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of all documents, each closed by ``end_id``, as segments under ``path``. ``encoder()`` makes
    a function of a text; if that has a method ``many``, it gets the texts as Arrow arrays."""
    keyed = docs.select(F.col(id_col).cast("bigint").alias("id"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = keyed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(-(-size // RANGE_BYTES), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text").asc()]
    dealt = keyed.repartitionByRange(ranges, *order).sortWithinPartitions(*order)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seg, before = encoder(), TaskContext.get().partitionId(), 0, 0
        many = getattr(encode, "many", None) or (lambda texts: map(encode, texts.to_pylist()))
        end = np.array([end_id], "<u4").tobytes()
        ids, held, n = [], [], 0

        def segment():
            counts = np.array([len(h) // 4 for h in held], np.int64)
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([seg], pa.int32()), pa.array([before], pa.int64()),
                pa.array([n], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                pa.array([counts], pa.list_(pa.int64())), pa.array([pack(np.frombuffer(b"".join(held), "<u4"))], pa.binary())],
                ["part", "seg", "before", "n_ids", "doc_ids", "counts", "payload"])

        for batch in batches:
            group = np.cumsum(pc.binary_length(batch.column("text")).to_numpy().astype(np.int64)) // GROUP_BYTES
            for lo, hi in pairwise([0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(batch)]):
                rows = batch.slice(lo, hi - lo)
                for i, coded in zip(rows.column("id").to_pylist(), many(rows.column("text")), strict=True):
                    ids.append(i)
                    held.append(coded + end)
                    n += len(held[-1]) // 4
                    if n >= SEGMENT_IDS:
                        yield segment()
                        ids, held, n, seg, before = [], [], 0, seg + 1, before + n
        if held:
            yield segment()

    (dealt.mapInArrow(code, "part int, seg int, before bigint, n_ids bigint, doc_ids array<bigint>, "
                            "counts array<bigint>, payload binary")
     .write.parquet(path))


def read_tokens(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """One row per document of a written folder: id, ``start`` (ids before it), ``n_tokens``,
    ``tokens`` (the ids) and ``crc32`` (of the ids as little-endian 32-bit integers)."""
    table = spark.read.parquet(path)
    # one row for every range of ids, which is as many as there were tasks: small enough to send to every task
    totals = table.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    bases = totals.selectExpr("part as base_part", "sum(ids) over (order by part) - ids as base")
    segments = (table.join(F.broadcast(bases), F.col("part") == F.col("base_part"))
                .select((F.col("base") + F.col("before")).alias("first"), "doc_ids", "counts", "payload"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                one = batch.slice(row, 1)
                first = one.column("first")[0].as_py()
                counts = one.column("counts")[0].values.to_numpy()
                tokens = unpack(one.column("payload")[0].as_py()).astype(np.uint32)
                ends = np.cumsum(counts)
                data = tokens.astype("<u4").tobytes()
                crc = [zlib.crc32(data[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(tokens.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([
                    one.column("doc_ids")[0].values, pa.array(first + ends - counts), pa.array(counts), lists,
                    pa.array(crc, pa.int64())], ["id", "start", "n_tokens", "tokens", "crc32"])

    out = segments.mapInArrow(decode, "id bigint, start bigint, n_tokens bigint, tokens array<int>, crc32 bigint")
    return out.withColumnRenamed("id", id_col)
