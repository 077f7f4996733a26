"""Removal of long repeats by sparse suffix arrays with common-prefix interval trees.

Any string of ``LENGTH`` bytes that starts in two places has, in both, the same least hash among
its ``GRAM``-byte substrings. So each text is cut into anchored segments: an anchor is the place of
that least hash, and its segment holds all strings of ``LENGTH`` bytes that choose it. Equal strings
lie in segments with equal anchors, and the rest runs per anchor.

1. Anchors that occur once in all texts are dropped, by a count that shrinks on the map side.
2. Anchors whose segments are all equal, as in copies, are repeats as a whole: no bytes are moved.
3. For the other anchors one segment per content is fetched, and the suffixes that start at the
   anchor are sorted. A scan with a stack over the lengths of common prefixes yields the interval
   tree: each interval is a set of occurrences with a common right extension. Inside an interval,
   the same scan over the reversed left contexts finds where left extensions become diverse. What is
   diverse on both sides is a maximal repeat, and all its occurrences are put out, not only
   neighbours in the order. Segments end where their strings end, and so do the repeats found there.
4. Anchors with more than ``CROWD`` different segments are never gathered. A string of ``LENGTH``
   bytes has some number of bytes before the anchor; the range of that number is cut into ``PARTS``
   again and again. Strings of one part share at least so many bytes on the left and so many on the
   right, and segments that differ there go separate ways: groups of one are done, groups of at most
   ``CROWD`` are scanned as above. Of larger groups the least and the greatest hash of all bytes that
   the strings of the part cover are taken: where they agree, the whole part is a repeat of all members,
   put out as one span each; only parts that hold an edge of what is shared are cut again. At a single
   number all of a group share a string. Each round is one shuffle of the crowded segments; four rounds
   end it. Repeats found so end at the borders of their part, too; the bytes they cover are the same.

Texts are compared as UTF-8 bytes; a match never crosses from one text into another.

Defined results: missing text is empty; texts shorter than ``LENGTH`` lose nothing; repeated rows
are copies of each other and both lose what they share; an empty table gives an empty table.
Columns other than id and text are kept by ``remove_repeats`` and ignored elsewhere.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, written
from .shingles import BASE, U64, mixed
from .text import slices

LENGTH = 200
GRAM = 24
CROWD = 512
PARTS = 4
BATCH = 1 << 20  # bytes handled at once; longer texts are handled in overlapping parts
PLACE_BITS = U64(22)  # places in a batch and the text that goes beyond it
KEY = ["d", "t"]  # id and hash of a text: equal only for equal rows


class Prefixes:
    """Hashes of all substrings of a buffer from one pass of running sums."""

    def __init__(self) -> None:
        self.value = np.random.default_rng(23).integers(1, 2**63, 256).astype(U64)
        self.powers = self.inverse = np.ones(1, U64)

    def load(self, data: np.ndarray) -> None:
        n = len(data) + 1
        if len(self.powers) < n:
            tables = []
            for base in (BASE, pow(BASE, -1, 2**64)):
                steps = np.full(n, base, U64)
                steps[0] = 1
                tables.append(np.multiply.accumulate(steps))
            self.powers, self.inverse = tables
        self.sums = np.zeros(n, U64)
        np.cumsum(self.value[data] * self.powers[:n - 1], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[begin]) * self.inverse[begin])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    have, out = 1, values
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def segments(texts: list[bytes], prefixes: Prefixes) -> dict[str, np.ndarray]:
    """Anchored segments of texts: ``doc``, ``at`` (first string), ``left`` (bytes before the
    anchor), ``count`` (strings), ``h`` (anchor) and ``seg`` (hashes of anchor and content)."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    first = np.cumsum(sizes) - sizes
    empty = {k: np.zeros(0, np.int64) for k in ("doc", "at", "left", "count", "h", "seg")}
    if len(data) < LENGTH:
        return empty
    prefixes.load(data)
    places = np.arange(len(data) - GRAM + 1)
    grams = prefixes.of(places, places + GRAM)
    # high bits of the hash, then the place: of equal ones the leftmost is least
    ranked = ((grams >> PLACE_BITS) << PLACE_BITS) | places.astype(U64)
    anchor = (_least(ranked, LENGTH - GRAM + 1) & ((U64(1) << PLACE_BITS) - U64(1))).astype(np.int64)
    starts = np.arange(len(anchor))
    doc = np.searchsorted(first, starts, side="right") - 1
    inside = starts + LENGTH <= first[doc] + sizes[doc]
    starts, doc, anchor = starts[inside], doc[inside], anchor[inside]
    if not len(starts):
        return empty
    new = np.flatnonzero(np.concatenate(
        ([True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | (starts[1:] != starts[:-1] + 1))))
    last = np.concatenate((new[1:], [len(starts)])) - 1
    at, to, p = starts[new], starts[last], anchor[new]
    h = grams[p]
    whole = prefixes.of(at, to + LENGTH) ^ mixed((p - at).astype(U64) * U64(1 << 20) + (to - at).astype(U64))
    return {"doc": doc[new], "at": at - first[doc[new]], "left": p - at, "count": to - at + 1,
            "h": h.view(np.int64), "seg": whole.view(np.int64)}


def _groups(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about BATCH bytes."""
    lo, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > BATCH:
            yield lo, i
            lo, held = i, 0
        held += n
    if lo < len(sizes):
        yield lo, len(sizes)


def _texts(docs: DataFrame, text: str, more: list | None = None) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("d"),
        F.xxhash64(body).alias("t"), F.encode(body, "UTF-8").alias("bytes"), *(more or []))


def anchors(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(h, seg, d, t, at, left, count)``: every anchored segment of every text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes = Prefixes()
        for batch in slices(batches):
            body = batch.column(2).to_pylist()
            parts = [(i, at, b[at:at + BATCH + LENGTH - 1]) for i, b in enumerate(body)
                     for at in range(0, max(len(b) - LENGTH + 1, 0), BATCH)]
            for lo, hi in _groups([len(p[2]) for p in parts]):
                s = segments([p[2] for p in parts[lo:hi]], prefixes)
                if not len(s["doc"]):
                    continue
                s["at"] = s["at"] + np.array([p[1] for p in parts[lo:hi]])[s["doc"]]
                rows = pa.array(np.array([p[0] for p in parts[lo:hi]])[s["doc"]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s["h"]), pa.array(s["seg"]), batch.column(0).take(rows),
                     batch.column(1).take(rows), pa.array(s["at"].astype(np.int32)),
                     pa.array(s["left"].astype(np.int16)), pa.array(s["count"].astype(np.int16))],
                    ["h", "seg", "d", "t", "at", "left", "count"])

    return _texts(docs, text).mapInArrow(
        run, "h long, seg long, d long, t long, at int, left short, count short")


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n - 1  # a[:lo] equal, a[:hi + 1] not
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[:mid] == b[:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def intervals(lcp: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """The interval tree of sorted strings, leaves left out: ``(depth, lo, hi)`` with ``hi`` inside.

    ``lcp[i]`` is the common prefix of strings ``i`` and ``i + 1``. One scan with a stack.
    """
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*lcp, -1]):
        lo = i
        while stack and stack[-1][0] > depth:
            top, lo = stack.pop()
            if top >= least:
                yield top, lo, i
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, lo))


def maximal_repeats(lefts: list[bytes], rights: list[bytes]) -> Iterator[tuple[int, int, list[int]]]:
    """Maximal repeats around one anchor: ``(left, right, members)``.

    ``lefts`` are the reversed contexts before the anchor, ``rights`` what starts at it. All members
    share ``left`` bytes before and ``right`` bytes from the anchor on, and differ beyond on both
    sides; together these are ``LENGTH`` bytes or more.
    """
    order = sorted(range(len(rights)), key=rights.__getitem__)
    by_left = sorted(range(len(lefts)), key=lefts.__getitem__)
    place = {m: i for i, m in enumerate(by_left)}
    lcp = [common_prefix(rights[a], rights[b]) for a, b in zip(order, order[1:])]
    longest = max(map(len, lefts))
    for depth, lo, hi in intervals(lcp, LENGTH - longest):
        inside = sorted(range(lo, hi + 1), key=lambda i: place[order[i]])
        members = [order[i] for i in inside]
        near = [common_prefix(lefts[a], lefts[b]) for a, b in zip(members, members[1:])]
        borders = [i for i in range(lo, hi) if lcp[i] == depth]  # between the children
        for left, a, b in intervals(near, max(LENGTH - depth, 0)):
            children = {bisect_right(borders, i - 1) for i in inside[a:b + 1]}
            if len(children) > 1:
                yield left, depth, members[a:b + 1]


def _hash(body: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(body, digest_size=8).digest(), "little", signed=True)


def _covered(rows: list[tuple]) -> Iterator[tuple[int, int, int, int]]:
    """``(seg, start, length, repeat)`` for all members of all repeats of one anchor."""
    lefts = [body[:left][::-1] for _, left, body in rows]
    rights = [body[left:] for _, left, body in rows]
    for left, right, members in maximal_repeats(lefts, rights):
        one = members[0]
        content = lefts[one][:left][::-1] + rights[one][:right]
        name = _hash(content)
        for m in members:
            yield rows[m][0], rows[m][1] - left, left + right, name


def _scan(batches: Iterator[pa.RecordBatch], merged: bool) -> Iterator[pa.RecordBatch]:
    """Repeats per group of segments with one anchor, from rows sorted by group.

    ``merged`` puts overlapping repeats of a segment together, for those who need only the bytes.
    """
    now, rows, out = None, [], []

    def flush() -> None:
        if len(rows) < 2:
            return
        if not merged:
            out.extend((now[1], *r) for r in _covered(rows))
            return
        spans: dict[int, list] = {}
        for seg, start, length, _ in _covered(rows):
            spans.setdefault(seg, []).append({"start": start, "length": length})
        for seg, found in spans.items():
            out.extend((now[1], seg, a, b - a, 0) for a, b in _merged(found))

    def batch_of() -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 5
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["h", "seg", "start", "length", "repeat"])

    for batch in slices(batches, 2000):
        for group, h, seg, left, body in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if (group, h) != now:
                flush()
                now, rows = (group, h), []
                if len(out) > 20_000:
                    yield batch_of()
                    out = []
            rows.append((seg, left, body))
    flush()
    if out:
        yield batch_of()


SPLIT = "h long, seg long, left short, body binary, lo int, hi int, side long, start int, length int, content long"


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each segment once per part of its range that it has strings in, with a hash of the bytes that
    all strings of that part hold, and with place, length and hash of those that any of its strings holds."""
    for batch in slices(batches, 2000):
        out = []
        for h, seg, left, body, lo, hi in zip(*(batch.column(i).to_pylist() for i in range(6))):
            right = len(body) - left
            edges = [lo + (hi - lo) * i // PARTS for i in range(PARTS + 1)]
            for a, b in zip(edges, edges[1:]):
                least, most = max(a, LENGTH - right), min(b - 1, left)
                if least <= most:
                    start, end = left - most, left - least + LENGTH
                    out.append((h, seg, left, body, a, b, _hash(body[left - a:left + LENGTH + 1 - b]),
                                start, end - start, _hash(body[start:end])))
        columns = list(zip(*out)) or [()] * 10
        kinds = (pa.int64(), pa.int64(), pa.int16(), pa.binary(), pa.int32(), pa.int32(), pa.int64(),
                 pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            ["h", "seg", "left", "body", "lo", "hi", "side", "start", "length", "content"])


def _parted(crowd: DataFrame, made: list[DataFrame] | None) -> tuple[DataFrame, DataFrame | None]:
    """Groups to scan, and repeats found outright, from crowded segments."""
    where = ["h", "lo", "hi", "side"]
    scans, found = None, None
    rows = crowd.select("h", "seg", "left", "body", F.lit(0).alias("lo"), F.lit(LENGTH - GRAM + 1).alias("hi"))
    while not rows.isEmpty():
        split = written(rows.mapInArrow(_split, SPLIT), "split")
        sizes = split.groupBy(*where).agg(
            F.count("*").alias("n"), (F.min("content") == F.max("content")).alias("whole")).where("n > 1")
        met = written(split.join(sizes, where), "parted", made)
        discard(split)
        scan = met.where(F.col("n") <= CROWD).select(
            F.xxhash64(*where).alias("group"), "h", "seg", "left", "body")
        shared = met.where((F.col("n") > CROWD) & F.col("whole")).select(
            "h", "seg", "start", "length", F.col("content").alias("repeat"))
        scans = scan if scans is None else scans.union(scan)
        found = shared if found is None else found.union(shared)
        rows = met.where((F.col("n") > CROWD) & ~F.col("whole")).select("h", "seg", "left", "body", "lo", "hi")
    return scans, found


def contexts(docs: DataFrame, mixed_segments: DataFrame, text: str) -> DataFrame:
    """``(h, seg, left, body)``: the bytes of one segment per content."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, bodies = [], []
            for i, (body, places) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                for p in places:
                    rows.append(p)
                    bodies.append(body[p["at"]:p["at"] + p["count"] - 1 + LENGTH])
                if len(rows) > 10_000 or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p["h"] for p in rows], pa.int64()),
                         pa.array([p["seg"] for p in rows], pa.int64()),
                         pa.array([p["left"] for p in rows], pa.int16()), pa.array(bodies, pa.binary())],
                        ["h", "seg", "left", "body"])
                    rows, bodies = [], []

    one = mixed_segments.groupBy("h", "seg").agg(
        F.min(F.struct("d", "t", "at", "left", "count")).alias("r"))
    wanted = one.groupBy("r.d", "r.t").agg(F.collect_list(
        F.struct("h", "seg", "r.at", "r.left", "r.count")).alias("places"))
    # equal rows have the same text: either may serve
    met = _texts(docs, text).join(wanted, KEY).select("bytes", "places")
    return met.mapInArrow(run, "h long, seg long, left short, body binary").dropDuplicates(["h", "seg"])


def repeats(docs: DataFrame, text: str = "text", merged: bool = False,
            made: list[DataFrame] | None = None) -> DataFrame:
    """``(d, t, start, length, repeat)``: every occurrence of every repeat.

    ``repeat`` names the repeated content; segments that are equal as a whole are named by hash.
    With ``merged``, overlapping repeats of one segment are put together and have no name.
    """
    every = written(anchors(docs, text), "anchors")
    # a table of its own, so that a join with a hot anchor can be split
    often = written(every.groupBy("h").agg(
        F.count("*").alias("n"), F.min("seg").alias("low"), F.max("seg").alias("high")).where("n > 1"), "often")
    found = written(every.join(often, "h").select(
        *every.columns, (F.col("low") != F.col("high")).alias("mixed")), "segments", made)
    discard(every, often)
    same = found.where("not mixed")
    other = found.where("mixed")
    per_content = other.groupBy("h", "seg").agg(F.count("*").alias("n"))
    crowd = per_content.groupBy("h").agg(F.count("*").alias("contents"))
    bodies = written(contexts(docs, other, text).join(crowd, "h"), "contexts", made)
    groups = bodies.where(F.col("contents") <= CROWD).select(
        F.col("h").alias("group"), "h", "seg", "left", "body")
    scans, strings = _parted(bodies.where(F.col("contents") > CROWD), made)
    groups = groups if scans is None else groups.union(scans)
    scanned = groups.repartition("group").sortWithinPartitions("group", "h").mapInArrow(
        lambda batches: _scan(batches, merged), "h long, seg long, start int, length int, repeat long")
    scanned = scanned if strings is None else scanned.union(strings)
    inner = scanned.join(other, ["h", "seg"]).select(
        *KEY, (F.col("at") + F.col("start")).alias("start"), "length", "repeat")
    size = (F.col("count") - 1 + LENGTH).cast("int").alias("length")
    whole = same.union(other.join(per_content.where("n > 1").drop("n"), ["h", "seg"], "left_semi")
                       .select(*same.columns))
    return whole.select(*KEY, F.col("at").alias("start"), size, F.col("seg").alias("repeat")).union(inner)


def _merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Removed runs: overlapping and touching spans together."""
    out: list[list[int]] = []
    for s in sorted((s["start"], s["start"] + s["length"]) for s in spans or ()):
        if out and s[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s[1])
        else:
            out.append(list(s))
    return [(a, b) for a, b in out]


def _cut(batches: Iterator[pa.RecordBatch], as_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        out = []
        for body, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            runs = _merged(spans)
            parts, last = [], 0
            for a, b in runs:
                parts.append(body[last:a])
                last = b
            kept = b"".join([*parts, body[last:]])
            out.append({"n_bytes": len(body), "n_removed": len(body) - len(kept), "n_spans": len(runs),
                        "kept_sha256": hashlib.sha256(kept).hexdigest(),
                        "kept": kept.decode("utf-8", "ignore") if as_text else kept})
        made = pa.RecordBatch.from_pylist(out, schema=pa.schema([
            ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
            ("kept_sha256", pa.string()), ("kept", pa.string() if as_text else pa.binary())]))
        yield pa.RecordBatch.from_arrays(
            [*made.columns, *batch.columns[2:]], [*made.schema.names, *batch.schema.names[2:]])


def cut_repeats(docs: DataFrame, text: str = "text", as_text: bool = False) -> DataFrame:
    """``n_bytes, n_removed, n_spans, kept_sha256, kept`` for every row, and as ``_0``, ``_1``, ...
    the columns of ``docs`` other than the text. ``kept`` is binary, or text without what is left of
    characters that were cut apart."""
    made: list[DataFrame] = []
    spans = written(repeats(docs, text, True, made).groupBy(*KEY).agg(
        F.collect_list(F.struct("start", "length")).alias("_spans")), "spans")
    discard(*made)
    rest = [c for c in docs.columns if c != text]
    keyed = _texts(docs, text, [F.col(c).alias(f"_{i}") for i, c in enumerate(rest)])
    met = keyed.join(spans, KEY, "left").select("bytes", "_spans", *[f"_{i}" for i in range(len(rest))])
    kinds = dict(docs.dtypes)
    passed = "".join(f", _{i} {kinds[c]}" for i, c in enumerate(rest))
    return met.mapInArrow(
        lambda batches: _cut(batches, as_text),
        "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept "
        + ("string" if as_text else "binary") + passed)


def remove_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the repeated bytes."""
    rest = [c for c in docs.columns if c != text]
    out = cut_repeats(docs, text, as_text=True)
    names = {c: f"_{i}" for i, c in enumerate(rest)} | {text: "kept"}
    return out.select(*[F.col(names[c]).alias(c) for c in docs.columns])
