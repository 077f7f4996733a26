"""SentencePiece encoding and decoding of whole texts, by a relational lattice of pieces.

Text is written with a mark for every blank and one in front, and cut before the marks, and where letters meet other
characters if no piece of the model holds both (``cutting`` looks): no piece worth using reaches over a cut, so
each run of characters has a path of its own.

1. The different runs of all texts are counted; each is worked on once, however often it occurs.
2. ``lattice``: every run is exploded into its substrings of bounded length, these meet the piece table by an
   equi-join (the table is as large as the model at most, and broadcast; it leaves out pieces that are on no best path,
   see ``worth``), the pieces found are grouped by run, as edges in the order of their ends, and a higher-order
   aggregate folds them: it keeps the best score of each end (Viterbi) and the length of the piece that reached it,
   and these give the path from its end. The runs stay where the count put them.
3. Texts meet their runs: the ``HEAD`` most frequent runs travel with the tasks; the others are joined by run to
   the hashes of the texts that hold them, and each hash gathers its own. A run that half of all texts hold is in the
   head. Texts move once, packed, to what their hash gathered.

Each step is written before the next one, and its shuffle files go then: the disk holds those of one step.

A character without a piece is spelt in bytes, and so is a mark that stands in the text itself, so
that decoding can tell it from a blank. The best path under the scores of the file is what a unigram
model of these pieces gives; files trained for merges (BPE) are read the same way, so their
segmentation follows the scores and not the order of merges. Ties go to the longer last piece.

Runs of more than ``LONG`` characters (text without blanks) would make edges without bound. They are rare and go
through the same recurrence where they stand, a stretch at a time: only scores that a piece can still reach
go on to the next one (``Encoder``).

Decoding joins the bytes of all pieces of a text and takes a leading blank off.

Defined results: missing and empty texts have no pieces, and no pieces are an empty text; ids that
are no text (controls, unknown ones) decode to nothing; missing ids decode to a missing text;
repeated rows get equal results each; an empty table gives an empty table. Existing result columns
are replaced.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from functools import cache
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import spread_join
from ..session import discard, written
from .text import slices, text_of

MARK = "▁"  # stands for a blank
HEAD = 150_000  # runs whose ids travel with the tasks
SLICE = 256  # texts that Python holds at a time
SEEN = 1_000_000  # hashes of texts that a task remembers
LONG = 64  # characters of a run that becomes rows
SHORT = 4  # characters of a piece; longer ones are looked for only where one of their tails of so many stands
STRETCH = 1024  # characters of a word after which only the scores still in reach go on
UNKNOWN_MARGIN = 10.0  # below the least score
LEAST_USED = -1e8  # longer pieces at or below this score are never taken
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def piece_table(model: str | None = None) -> list[tuple[str, int, float]]:
    """``(piece, id, score)`` of the pieces that text can hold; one row per entry of the file."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=model or default_model())
    plain = [i for i in range(p.get_piece_size())
             if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i))]
    rows = [(p.id_to_piece(i), i, float(p.get_score(i))) for i in plain]
    return [r for r in rows if r[2] > LEAST_USED or len(r[0]) == 1]


def byte_ids(model: str | None = None) -> list[int]:
    """The ids of the 256 byte pieces, in order."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=model or default_model())
    return [p.piece_to_id(f"<0x{b:02X}>") for b in range(256)]


def marked_words(text: Column) -> Column:
    """The words of a text, without their marks: blanks part them, also several in a row."""
    return F.when(text == "", F.expr("cast(array() as array<string>)")).otherwise(F.split(text, " ", -1))


def cutting(pieces: list[tuple[str, int, float]]) -> str:
    """A pattern of the runs of a text with a blank in front. A mark of the text itself is a run."""
    import regex

    mixed = regex.compile(rf"[\p{{L}}\p{{M}}][^\p{{L}}\p{{M}}]|[^\p{{L}}\p{{M}}{MARK}][\p{{L}}\p{{M}}]")
    if any(mixed.search(piece) for piece, _, _ in pieces):
        return f" ?[^ {MARK}]+| |{MARK}"
    return rf" ?[\p{{L}}\p{{M}}]+| ?[^\p{{L}}\p{{M}} {MARK}]+| |{MARK}"


def runs_of(text: Column, pattern: str) -> Column:
    whole = F.regexp_extract_all(F.concat(F.lit(" "), text), F.lit(pattern), F.lit(0))
    return F.when(text == "", F.expr("cast(array() as array<string>)")).otherwise(whole)


@cache
def letters() -> str:
    """``\\p{L}\\p{M}`` of the characters up to U+FFFF as ranges, which ``re`` knows and looks up faster."""
    import regex

    low = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))
    found = [m.group() for m in regex.finditer(r"[\p{L}\p{M}]+", low)]
    return "".join(f"\\u{ord(f[0]):04x}-\\u{ord(f[-1]):04x}" for f in found)


def cutter(pattern: str, low: str) -> Callable[[str], list[str]]:
    """What ``runs_of`` does, in Python; ``low`` are the ``letters``."""
    import re

    import regex

    every, fast = regex.compile(pattern).findall, re.compile(pattern.replace(r"\p{L}\p{M}", low)).findall

    def runs(text: str) -> list[str]:
        if not text:
            return []
        all_low = len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text)
        return (fast if all_low else every)(" " + text)

    return runs


def worth(pieces: list[tuple[str, int, float]]) -> list[tuple[str, int, float]]:
    """The pieces that a best path may hold.

    Shorter pieces that make up one's text and score better in sum beat it in every path, so it is on none. Ties
    stay, and what the rounding of the scores of a run could make one. Single characters stay.
    """
    score: dict[str, float] = {}
    for piece, _, s in pieces:
        score[piece] = max(s, score.get(piece, -inf))
    margin = 1e-12 * LONG * max(map(abs, score.values()))

    def parted(piece: str) -> float:
        best = [0.0] + [-inf] * len(piece)
        for end in range(1, len(piece) + 1):
            for start in range(end == len(piece), end):
                s = score.get(piece[start:end])
                if s is not None and best[start] + s > best[end]:
                    best[end] = best[start] + s
        return best[-1]

    beaten = {piece for piece, s in score.items() if len(piece) > 1 and parted(piece) > s + margin}
    return [r for r in pieces if r[0] not in beaten]


# Edges come in the order of their ends, each with that of one character first. ``ends`` has the best score of each end
# that is settled and the length of its last piece, the latest end first; ``best`` is that of the end at hand.
FOLD = """
    aggregate(edges, named_struct('ends', cast(array() as array<struct<s: double, l: int>>),
                                  'best', named_struct('s', 0d, 'l', 0)),
      (a, x) -> if(x.l = 1,
        named_struct('ends', array_prepend(a.ends, a.best), 'best', named_struct('s', a.best.s + x.score, 'l', 1)),
        if(a.ends[x.l - 1].s + x.score >= a.best.s,
          named_struct('ends', a.ends, 'best', named_struct('s', a.ends[x.l - 1].s + x.score, 'l', x.l)), a)),
      a -> array_prepend(a.ends, a.best))"""

# The pieces from the last to the first, with a blank after each. The start of the run is an end too, and none to write.
BACK = """
    substring(aggregate(ends, named_struct('at', char_length(run), 'to', char_length(run), 'path', ''),
      (a, x) -> if(a.at = a.to,
        named_struct('at', a.at - 1, 'to', a.to - x.l,
          'path', concat(substring(run, a.at - x.l + 1, x.l), ' ', a.path)),
        named_struct('at', a.at - 1, 'to', a.to, 'path', a.path)),
      a -> a.path), 2)"""


def lattice(runs: DataFrame, pieces: list[tuple[str, int, float]]) -> DataFrame:
    """``(run, n, path)``: the best path of each different run, as its pieces with a blank after each.

    Characters without piece stand alone. ``runs`` must be dealt by run: nothing here is shuffled.
    """
    spark = runs.sparkSession
    unknown = min(score for _, _, score in pieces) - UNKNOWN_MARGIN
    used = worth(pieces)
    longest = max(len(piece) for piece, _, _ in used)
    tails = sorted({piece[-SHORT:] for piece, _, _ in used if len(piece) > SHORT})
    table = spark.createDataFrame(used, "piece string, id int, score double").groupBy("piece").agg(
        F.max("score").alias("score"))
    # rows come in the order of ``k``: what groups the edges has next to nothing to sort
    marked = runs.select(F.monotonically_increasing_id().alias("k"), "run", "n",
                         F.replace("run", F.lit(" "), F.lit(MARK)).alias("marked"))
    ends = marked.select("k", "run", "n", "marked", F.explode(F.sequence(F.lit(1), F.char_length("marked"))).alias("e"))
    tail = F.substring("marked", F.col("e") - (SHORT - 1), F.lit(SHORT))
    room = F.least(F.when(tail.isin(tails), longest).otherwise(SHORT), F.col("e"))
    parts = ends.select("k", "run", "n", "marked", "e", F.explode(F.sequence(F.lit(1), room)).alias("l")).select(
        "k", "run", "n", "e", "l", F.expr("substring(marked, e - l + 1, l)").alias("piece"))
    met = parts.join(F.broadcast(table), "piece", "left").where(F.col("score").isNotNull() | (F.col("l") == 1))
    edges = met.groupBy("k", "run", "n").agg(F.sort_array(F.collect_list(F.struct(
        "e", "l", F.coalesce("score", F.lit(unknown)).alias("score")))).alias("edges"))
    path = edges.select("run", "n", F.expr(FOLD).alias("ends")).select("run", "n", F.expr(BACK).alias("path"))
    marked_path = F.when(F.startswith("run", F.lit(" ")), F.concat(F.lit(MARK), F.expr("substring(path, 2)"))).otherwise(F.col("path"))
    return path.select("run", "n", marked_path.alias("path"))


class Encoder:
    """Ids of texts, as bytes of 32-bit numbers, from known runs; long runs are worked out here."""

    def __init__(self, pieces: list[tuple[str, int, float]], bytes_: list[int], head: dict[str, bytes],
                 runs: Callable[[str], list[str]]) -> None:
        self.ids = {}
        for piece, i, _ in sorted(pieces, reverse=True):
            self.ids[piece] = i
        self.bytes, self.head, self.runs = bytes_, head, runs
        self.longest = max(len(piece) for piece in self.ids)
        self.unknown = min(score for _, _, score in pieces) - UNKNOWN_MARGIN
        # by character: the same for the next one, and the score, None for what only begins a piece
        self.start: dict[str, list] = {}
        for piece, _, score in pieces:
            at = self.start
            for char in piece[:-1]:
                at = at.setdefault(char, [{}, None])[0]
            at.setdefault(piece[-1], [{}, None])[1] = score

    def text(self, text: str, more: dict[str, bytes]) -> bytes:
        runs, head = self.runs(text), self.head
        parts = list(map(head.get, runs))
        if None in parts:
            parts = [p if p is not None else more[r] if r in more else self._new(r) for p, r in zip(parts, runs)]
        return b"".join(parts)

    def known(self, paths: str) -> dict[str, bytes]:
        """Runs and their ids, of paths as ``lattice`` gives them, with one more blank between."""
        found = {}
        for path in paths[:-1].split("  ") if paths else ():
            pieces = path.split(" ")
            run = "".join(pieces)
            found[" " + run[1:] if run[0] == MARK else run] = array("i", self._ids(pieces)).tobytes()
        return found

    def _ids(self, pieces: list[str]) -> list[int]:
        try:
            return [self.ids[p] for p in pieces]
        except KeyError:  # a character without piece
            return [i for p in pieces for i in ([self.ids[p]] if p in self.ids else self._spelt(" " if p == MARK else p))]

    def _new(self, run: str) -> bytes:
        if run == MARK:
            return array("i", self._spelt(MARK)).tobytes()
        return self.path(run.replace(" ", MARK)).tobytes()

    def _spelt(self, char: str) -> list[int]:
        return [self.bytes[b] for b in char.encode("utf-8", "replace")]

    def path(self, part: str) -> array:
        """The ids of the best path, first to last."""
        size, longest, first, unknown = len(part), self.longest, self.start, self.unknown
        took = bytearray(size + 1) if longest < 256 else array("i", bytes(4 * (size + 1)))
        best = [0.0]
        for done in range(0, size, STRETCH):
            stretch = min(STRETCH, size - done)
            best += [-inf] * (stretch + longest + 1 - len(best))
            for start in range(stretch):
                here, end, node = best[start], start, (first, None)
                for char in part[done + start:done + start + longest]:
                    node = node[0].get(char)
                    if node is None:
                        break
                    end += 1
                    if node[1] is not None and here + node[1] > best[end]:
                        best[end] = here + node[1]
                        took[done + end] = end - start
                one = first.get(part[done + start])
                if (one is None or one[1] is None) and here + unknown > best[start + 1]:
                    best[start + 1] = here + unknown
                    took[done + start + 1] = 1
            best = best[stretch:]
        out, end = array("i"), size
        while end:
            piece = part[end - took[end]:end]
            known = self.ids.get(piece)
            if known is not None:
                out.append(known)
            else:
                out.extend(reversed(self._spelt(" " if piece == MARK else piece)))
            end -= took[end]
        out.reverse()
        return out


class Decoder:
    """The bytes of each id; none for ids that are no text."""

    def __init__(self, pieces: list[tuple[str, int, float]], bytes_: list[int]) -> None:
        known = {i: piece.replace(MARK, " ").encode() for piece, i, _ in pieces}
        known.update((i, bytes([b])) for b, i in enumerate(bytes_))
        self.parts = np.array([known.get(i, b"") for i in range(max(known) + 1)], dtype=object)

    def text(self, ids: pa.Array) -> str:
        """The text of the ids; missing ones are no text either."""
        ids = ids.drop_null().to_numpy(zero_copy_only=False)
        if ids.size and (ids.min() < 0 or ids.max() >= len(self.parts)):
            ids = ids[(ids >= 0) & (ids < len(self.parts))]
        return b"".join(self.parts[ids].tolist()).removeprefix(b" ").decode("utf-8", "replace")


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``written``; the shuffle files it took go with it, not when the driver collects its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(FREED)
    conf.set(FREED, "true")
    try:
        return written(df, name)
    finally:
        conf.set(FREED, before)


def encoded_runs(docs: DataFrame, pieces: list, pattern: str, text: str) -> DataFrame:
    """``(run, n, path)`` of all different runs of at most ``LONG`` characters."""
    every = docs.select(F.explode(runs_of(text_of(text), pattern)).alias("run")).where(
        (F.char_length("run") <= LONG) & (F.col("run") != MARK))
    counted = every.groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    return _kept(lattice(counted, pieces), "runs")


def encode(docs: DataFrame, model: str | None = None, text: str = "text", back: bool = False) -> DataFrame:
    """``docs`` with ``ids``, the ids of each text, in order, and if ``back`` with ``decoded``, the text they stand for.

    Both in one pass need one Python worker a task where ``decode`` after ``encode`` needs two, each with its tables.
    """
    pieces, bytes_ = piece_table(model), byte_ids(model)
    pattern, low = cutting(pieces), letters()
    table = encoded_runs(docs, pieces, pattern, text)
    coder, head = Encoder(pieces, bytes_, {}, cutter(pattern, low)), {}
    for r in table.orderBy(F.desc("n"), "run").limit(HEAD).select("path").toLocalIterator():
        head |= coder.known(r["path"])
    shared = docs.sparkSession.sparkContext.broadcast(head)  # ``HEAD`` runs of ``LONG`` characters at most

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, known, seen = cutter(pattern, low), shared.value, set()
        for batch in slices(batches, SLICE):
            keys, found = array("q"), []
            for key, t in zip(*(c.to_pylist() for c in batch.columns)):
                if key not in seen:
                    new = [r for r in set(runs(t)) if r not in known and len(r) <= LONG and r != MARK]
                    keys.extend([key] * len(new))
                    found += new
                    seen.add(key)
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(keys, np.int64)), pa.array(found, pa.string())], ["__text", "run"])
            if len(seen) > SEEN:
                seen.clear()

    def pack(text: str | None) -> bytes | None:
        import zstandard

        return None if text is None else zstandard.compress(text.encode(), 1)

    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        import zstandard

        encoder = Encoder(pieces, bytes_, shared.value, cutter(pattern, low))
        decoder, unpack = Decoder(pieces, bytes_) if back else None, zstandard.ZstdDecompressor().decompress
        for texts, paths in batches:
            for lo in range(0, len(texts), SLICE):  # few rows at a time: what Python holds of a batch stays small
                whole = [None if t is None else unpack(t).decode() for t in texts.slice(lo, SLICE).to_pylist()]
                yield part(encoder, decoder, whole, paths.slice(lo, SLICE).to_pylist())
        pa.default_memory_pool().release_unused()

    def part(encoder: Encoder, decoder: Decoder | None, texts: list[str | None], paths: list[str | None]) -> pa.Array:
        coded = [encoder.text(t or "", encoder.known(p or "")) for t, p in zip(texts, paths)]
        offsets = np.cumsum([0, *(len(c) // 4 for c in coded)], dtype=np.int64)
        values = pa.array(np.frombuffer(b"".join(coded), np.int32))
        out = [pa.array(texts, pa.string()), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)]
        if decoder is not None:
            out.append(pa.array([decoder.text(x.values) for x in out[1]], pa.string()))
        return pa.StructArray.from_arrays(out, made)

    names = ["ids", "decoded"] if back else ["ids"]
    made = ["text", *names]
    kind = f"struct<text: string, ids: array<int>{', decoded: string' if back else ''}>"

    # texts are known by a hash, and copies share what they need; should two texts have one hash, either finds its own
    whole = text_of(text)
    wanted = docs.select(F.xxhash64(whole).alias("__text"), whole.alias("text")).mapInArrow(rare, "__text long, run string")
    met = wanted.join(table.select("run", "path"), "run").select("__text", "path").repartition("__text")
    others = _kept(met.groupBy("__text").agg(F.array_join(F.collect_set("path"), " ").alias("__paths")), "paths")
    discard(table)
    packed = docs.withColumns({"__text": F.xxhash64(whole), text: F.udf(pack, "binary", useArrow=False)(F.col(text))})
    joined = spread_join(packed, others, ["__text"])  # copies of one text may be a third of all rows
    coded = joined.withColumn("__coded", F.arrow_udf(run, kind)(F.col(text), F.col("__paths")))
    return coded.select(*[F.col("__coded.text").alias(c) if c == text else F.col(c) for c in docs.columns if c not in names],
                        *[F.col(f"__coded.{c}").alias(c) for c in names])


def decode(docs: DataFrame, model: str | None = None, ids: str = "ids") -> DataFrame:
    """``docs`` with ``decoded``, the whole text that ``ids`` stand for."""
    pieces, bytes_ = piece_table(model), byte_ids(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = Decoder(pieces, bytes_)
        for lists in batches:
            yield pa.array([decoder.text(x.values) if x.is_valid else None for x in lists], pa.string())

    return docs.withColumn("decoded", F.arrow_udf(run, "string")(F.col(ids)))


def measure(docs: DataFrame, model: str | None = None, text: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_pieces, ids_sum, ids_sha256, round_trip)`` for every row.

    The digest is that of the ids in order, in decimals with commas between. ``round_trip`` tells
    that the ids of the whole text decode to that text, byte for byte.
    """
    both = encode(docs.select("doc_id", text), model, text, back=True)
    return both.select(
        "doc_id", F.size(marked_words(text_of(text))).cast("long").alias("n_words"),
        F.size("ids").cast("long").alias("n_pieces"),
        F.aggregate("ids", F.lit(0).cast("long"), lambda a, x: a + x).alias("ids_sum"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        (F.col("decoded") == text_of(text)).alias("round_trip"))
