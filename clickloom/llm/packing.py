"""Packing of documents into training sequences along a space-filling curve.

1. Every document is tokenized once; its ids stay with it as two bytes each. Its vector counts ids
   in hashed bins (square roots, unit length), is projected to ``DIMS`` numbers by random signs, and
   these are cut into ``BITS`` bits each. The Hilbert index of that cell is the document's key.
2. The keys alone (no ids) are range-sorted, and every document gets the number of ids before it on
   the curve: a running sum inside each range, plus the sums of the ranges before it. Documents with
   equal keys (copies, say) are ordered by id and row, so a range never has to hold them all.
3. The ids meet their start by one join on a unique row number, and each document is cut at the
   multiples of the sequence length. Neighbours on the curve share a sequence, all sequences but the
   last are full, and the last is as long as it needs to be.

Defined results: a missing or empty text has only the end id; repeated rows are packed each on its
own; very long texts run through several sequences; an empty table gives no pieces. Of extra
columns none is kept.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written
from .text import slices

LENGTH = 4096  # ids in a sequence
END = 2  # id after each document
BINS = 256
DIMS = 4
BITS = 12
SEED = 7
CACHE = 300_000  # words whose ids a task keeps at hand; the cache is emptied when it is full
SPECIAL = ("<|startoftext|>", "<|endoftext|>")
# Fixed value: what the tokenizer takes for a word, after NFC and lower case.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
END_OF_WORD = "</w>"
MARK = b"\xff"  # stands for the end of a word; never part of UTF-8


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Words:
    """Ids of a text, word by word, by the merges of a tokenizer file with word ends.

    Words recur, so their ids are kept. White space ends a word whatever stands around it, so a
    text's ids are those of its parts between blanks. New words go through a fast merge of byte
    pairs on the same vocabulary; texts that hold the name of a special token, or letters outside
    the ranges for which both ways were compared, go through the tokenizer itself.
    """

    def __init__(self, path: str) -> None:
        import json

        import regex
        import tiktoken

        self.path, self.tokenizer = path, None
        vocabulary = json.load(open(path))["model"]["vocab"]
        byte = {c: b for b, c in _byte_letters().items()}
        ranks = {}
        for token, number in vocabulary.items():
            ends = token.endswith(END_OF_WORD) and token != END_OF_WORD
            letters = token[:-len(END_OF_WORD)] if ends else token
            ranks[bytes(byte[c] for c in letters) + (MARK if ends else b"")] = number
        self.merge = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks,
                                       special_tokens={})._core_bpe.encode_single_piece
        self.split = regex.compile(WORD).findall
        self.known: dict[str, bytes] = {"": b""}

    def _whole(self, text: str) -> bytes:
        """By the tokenizer itself, which few texts need."""
        from tokenizers import Tokenizer

        self.tokenizer = self.tokenizer or Tokenizer.from_file(self.path)
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u2").tobytes()

    def _new(self, part: str) -> bytes:
        if part.isascii():
            words = self.split(part.lower())
        else:
            letters = unicodedata.normalize("NFC", part)
            if max(letters) > "ɏ":
                return self._whole(part)
            words = self.split("".join(c.lower() for c in letters))
        ids = [i for w in words for i in self.merge(w.encode() + MARK)]
        return np.array(ids, "<u2").tobytes()

    def encode(self, text: str) -> bytes:
        """Ids as unsigned little-endian 16-bit numbers."""
        if any(s in text for s in SPECIAL):
            return self._whole(text)
        known = self.known
        parts = text.replace("\n", " ").split(" ")
        try:
            return b"".join([known[p] for p in parts])
        except KeyError:
            pass
        if len(known) > CACHE:
            known.clear()
            known[""] = b""
        for p in parts:
            if p not in known:
                known[p] = self._new(p)
        return b"".join([known[p] for p in parts])


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable ones as they are, the rest from U+0100 on."""
    plain = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174}
    rest = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(rest)) for b in range(256)}


def projection() -> np.ndarray:
    """Random signs, BINS x DIMS."""
    signs = np.random.default_rng(SEED).integers(0, 2, (BINS, DIMS))
    return (2.0 * signs - 1) / np.sqrt(BINS)


def points(ids: np.ndarray, lengths: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """The cells of documents in the grid, DIMS numbers of BITS bits each; ``ids`` holds them one after the other."""
    bins = (ids.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(24)
    at = np.repeat(np.arange(len(lengths)) * BINS, lengths)
    vectors = np.sqrt(np.bincount(at + bins, minlength=len(lengths) * BINS)).reshape(-1, BINS)
    vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1), 1e-12)[:, None]
    spread = vectors @ signs * np.sqrt(BINS)  # each about normal
    share = 1 / (1 + np.exp(-1.7 * spread))
    return np.minimum((share * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def hilbert(cells: np.ndarray) -> np.ndarray:
    """Place of each cell (rows of BITS-bit numbers) on the Hilbert curve.

    The high bits are handled first: where a cell lies in the upper half of an axis, the lower bits
    of the first axis are mirrored, else they change places with those of the axis (Skilling 2004).
    """
    x = [cells[:, d].astype(np.int64).copy() for d in range(cells.shape[1])]
    n = len(x)
    bit = 1 << (BITS - 1)
    while bit > 1:
        low = bit - 1
        for d in range(n):
            upper = (x[d] & bit) != 0
            swap = np.where(upper, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(upper, x[0] ^ low, x[0] ^ swap)
            x[d] = x[d] ^ swap if d else x[d]
        bit >>= 1
    for d in range(1, n):
        x[d] ^= x[d - 1]
    fix = np.zeros_like(x[0])
    bit = 1 << (BITS - 1)
    while bit > 1:
        fix = np.where((x[n - 1] & bit) != 0, fix ^ (bit - 1), fix)
        bit >>= 1
    key = np.zeros_like(x[0])
    for b in range(BITS - 1, -1, -1):
        for d in range(n):
            key = (key << 1) | (((x[d] ^ fix) >> b) & 1)
    return key


def tokenize(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``(doc_id, ids, n, key)`` per row of ``docs``; ``ids`` holds two bytes per id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, signs, end = Words(path), projection(), np.array([END], "<u2").tobytes()
        for batch in slices(batches):
            ids = [words.encode(t or "") + end for t in batch.column(1).to_pylist()]
            lengths = np.array([len(i) // 2 for i in ids], np.int64)
            cells = points(np.frombuffer(b"".join(ids), "<u2"), lengths, signs)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary()), pa.array(lengths),
                 pa.array(hilbert(cells), pa.int64())], ["doc_id", "ids", "n", "key"])

    cells = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    return cells.mapInArrow(run, "doc_id long, ids binary, n long, key long")


def running(ordered: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of ``n`` over the rows of this sorted range that come before each row."""
    part, before = TaskContext.get().partitionId(), 0
    for batch in ordered:
        n = batch.column(1).to_numpy()
        ends = before + np.cumsum(n)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(ends - n), pa.array(n),
             pa.array(np.full(len(n), part, np.int32))], ["row", "inside", "n", "part"])
        before = int(ends[-1]) if len(ends) else before


def starts(tokens: DataFrame) -> DataFrame:
    """``(row, first)``: ids before each document on the whole curve. Moves keys only."""
    spark = tokens.sparkSession
    keys = tokens.select("row", "n", "key", "doc_id")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = keys.repartitionByRange(parts, "key", "doc_id", "row").sortWithinPartitions(
        "key", "doc_id", "row").select("row", "n")
    inside = written(ordered.mapInArrow(running, "row long, inside long, n long, part int"), "curve")
    # one row per range: as many as shuffle partitions, whatever the data
    totals = inside.groupBy("part").agg(F.sum("n").alias("total"))
    offsets = totals.select("part", (F.sum("total").over(_by_part()) - F.col("total")).alias("offset"))
    return inside.join(F.broadcast(offsets), "part").select(
        "row", (F.col("inside") + F.col("offset")).alias("first"))


def _by_part():
    from pyspark.sql import Window

    return Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def cut(batches: Iterator[pa.RecordBatch], length: int, keep_ids: bool = True) -> Iterator[pa.RecordBatch]:
    """Pieces of documents: cut where a sequence ends."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    for batch in slices(batches):
        out, ids = [], []
        for doc, raw, first in zip(*(batch.column(i).to_pylist() for i in range(3))):
            wide = np.frombuffer(raw, "<u2").astype("<u4")
            n, at = len(wide), 0
            while at < n:
                sequence, offset = divmod(first + at, length)
                piece = wide[at:at + length - offset]
                out.append((doc, at, len(piece), zlib.crc32(piece), n, sequence, offset))
                if keep_ids:
                    ids.append(piece)
                at += len(piece)
        columns = [pa.array(c, pa.int64()) for c in (list(zip(*out)) or [()] * len(names))]
        if keep_ids:
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            values = np.concatenate(ids).astype(np.int32) if ids else np.empty(0, np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(values)))
        yield pa.RecordBatch.from_arrays(columns, [*names, "ids"] if keep_ids else names)


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, text: str = "text",
         keep_ids: bool = True) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and ``ids``, if kept."""
    path = path or default_tokenizer()
    numbered = tokenize(docs, path, text).withColumn("row", F.monotonically_increasing_id())
    tokens = written(numbered, "tokens")
    joined = tokens.select("row", "doc_id", "ids").join(starts(tokens), "row")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return joined.select("doc_id", "ids", "first").mapInArrow(
        lambda batches: cut(batches, length, keep_ids), f"{schema}, ids array<int>" if keep_ids else schema)
