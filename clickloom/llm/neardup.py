"""Near-duplicates by an inverted join of MinHash signatures, with links confirmed on full sets.

1. Each text becomes its set of word shingles, a signature of ``COORDINATES`` MinHash values and a
   128-bit name of the set. Texts with the same set form one class, whatever their number, and only
   classes go on; copies never meet each other.
2. Each class is posted under its (coordinate, value) pairs. Postings with one entry cannot match,
   so they are dropped by a count; a pair of classes with ``matches`` equal coordinates must then
   share a posting among the rarest ``COORDINATES - matches + 1`` of either (prefix). Long postings
   are thus skipped wherever rarer ones decide.
3. The sets of the classes that are left are made again, and the shingles of each that occur in
   another set too are counted. That number bounds every intersection of the set; it drops classes
   that cannot have a link, and pairs that cannot be one.
4. Within a posting, classes are not paired with each other. Each round, a posting proposes one
   pivot, the class with the largest share of common shingles; a class that is not yet connected to
   it counts its collisions per pivot, takes the best, and the link is confirmed. Postings whose
   classes are all connected are skipped from then on.
5. What ``ROUNDS`` rounds leave in postings with several components is searched whole, so that no
   link between components is lost: classes tied by such postings are cut into tiles of ``TILE``, two
   tiles meet in one task, and only confirmed links leave it. Signatures come first there too, and
   classes that the task has connected are not compared again.
6. A link needs ``matches`` equal coordinates and, on the full sets, the stated Jaccard similarity.

``matches`` is the largest number of equal coordinates that a pair with exactly that similarity
misses with a probability of ``MISS`` at most (binomial), and closer pairs more rarely. Of 64 these
are, by percent (missed, per million): 70: 27 (1.06), 75: 31 (1.36), 80: 35 (1.21),
85: 40 (2.42), 90: 45 (2.47), 95: 50 (0.47). Below 19 percent even one equal
coordinate is missed more often than that, which is an error.

Defined results: missing, empty and blank texts have no shingles and are linked with nothing; texts
with fewer words than a shingle are one shingle; repeated rows are linked with each other; rows
without an id are answered with their own null component and kept; an empty table gives an empty
table. Columns other than id and text are ignored, except by ``deduplicate``, which keeps them all.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard, written
from .components import components
from .shingles import Shingler, Signer, digest
from .text import slices

COORDINATES = 64
MISS = 2.5e-6  # of pairs at exactly the similarity asked for
ROUNDS = 1
TILE = 256
PERCENT = 80
WORDS = 5


def missed(least: int, percent: int) -> float:
    """The probability that a pair of this similarity has fewer than ``least`` equal coordinates."""
    p = percent / 100
    return sum(comb(COORDINATES, k) * p**k * (1 - p) ** (COORDINATES - k) for k in range(least))


def matches(percent: int) -> int:
    """How many equal coordinates a candidate must have."""
    found = max(m for m in range(COORDINATES + 1) if missed(m, percent) <= MISS)
    if not found:
        raise ValueError(f"{COORDINATES} coordinates do not find pairs of {percent} percent")
    return found


def _batches(batch: pa.RecordBatch, limit: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of a batch in groups of about ``limit`` bytes, with the place of the first."""
    texts, size, first = [], 0, 0
    for i, t in enumerate(batch.column(1).to_pylist()):
        texts.append((t or "").encode("utf-8", "replace"))
        size += len(texts[-1])
        if size >= limit:
            yield first, texts
            texts, size, first = [], 0, i + 1
    if texts:
        yield first, texts


def signatures(docs: DataFrame, words: int, text: str = "text") -> DataFrame:
    """``(doc_id, n, name, signature)`` per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, signer = Shingler(words), Signer(COORDINATES)
        for batch in slices(batches):
            for first, texts in _batches(batch):
                sets = shingler.sets(texts)
                signs = pa.array([signer.sign(s) if len(s) else None for s in sets], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[first:first + len(texts)], pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([digest(s) if len(s) else None for s in sets], pa.binary()), signs],
                    ["doc_id", "n", "name", "signature"])

    cells = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    return cells.mapInArrow(run, "doc_id long, n long, name binary, signature array<int>")


def full_sets(docs: DataFrame, wanted: DataFrame, words: int, text: str = "text") -> DataFrame:
    """``(node, n, hashes)`` of the classes ``wanted(node, rep, name)``, made from their texts again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in slices(batches):
            for first, texts in _batches(batch):
                part = batch.slice(first, len(texts))
                sets = shingler.sets(texts)
                right = [i for i, name in enumerate(part.column(2).to_pylist()) if digest(sets[i]) == name]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(right, pa.int64())),
                     pa.array([len(sets[i]) for i in right], pa.int64()),
                     pa.array([sets[i].view("int64") for i in right], pa.list_(pa.int64()))],
                    ["node", "n", "hashes"])

    cells = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col(text).alias("text"))
    met = cells.join(wanted, "rep").select("node", "text", "name")
    return met.mapInArrow(run, "node long, n long, hashes array<long>").dropDuplicates(["node"])


def postings(classes: DataFrame, percent: int, made: list[DataFrame]) -> DataFrame:
    """``(token, node, n)``: the postings in the prefix of each class that has enough shared ones."""
    coordinate = F.posexplode("signature").alias("c", "v")
    tokens = classes.select("node", "n", coordinate).select(
        "node", "n", ((F.col("c").cast("long") * F.lit(2**32)) + F.col("v").cast("long")).alias("token"))
    # a table of its own, so that a join with a hot token can be split
    shared = written(tokens.groupBy("token").agg(F.count("*").alias("often")).where("often > 1"), "tokens", made)
    met = tokens.join(shared, "token")
    # at most one row per coordinate and class: a window never holds more than COORDINATES rows
    by_class = Window.partitionBy("node")
    ranked = met.select(
        "token", "node", "n", F.count("*").over(by_class).alias("have"),
        F.row_number().over(by_class.orderBy("often", "token")).alias("place"))
    prefix = F.col("place") <= F.col("have") - matches(percent) + 1
    return ranked.where(prefix).select("token", "node", "n")


def _confirmed(pairs: DataFrame, signs: DataFrame, sets: DataFrame, percent: int,
               made: list[DataFrame]) -> DataFrame:
    """Pairs ``(a, b)`` with enough matches and the similarity asked for."""
    one, two = (signs.select(F.col("node").alias(c), F.col("signature").alias(f"s{c}")) for c in "ab")
    equal = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0),
                        lambda t, x: t + x)
    near = written(pairs.join(one, "a").join(two, "b").where(equal >= matches(percent)).select("a", "b"), "pairs", made)
    one, two = (sets.select(F.col("node").alias(c), F.col("hashes").alias(f"h{c}"),
                            F.col("n").alias(f"n{c}")) for c in "ab")
    both = near.join(one, "a").join(two, "b").select(
        "a", "b", "na", "nb", F.size(F.array_intersect("ha", "hb")).cast("long").alias("i"))
    return both.where(100 * F.col("i") >= percent * (F.col("na") + F.col("nb") - F.col("i"))).select("a", "b")


def common_shingles(sets: DataFrame) -> DataFrame:
    """``(node, m)``: how many shingles of each set some other set has too."""
    each = sets.select("node", F.explode("hashes").alias("s"))
    often = each.groupBy("s").agg(F.count("*").alias("often")).where("often > 1").drop("often")
    return each.join(often, "s").groupBy("node").agg(F.count("*").alias("m"))


def _may_link(n: str, m: str, other_n: str, other_m: str, percent: int):
    """Whether sets of these sizes, with so many shared shingles at most, can be similar enough."""
    most = F.least(m, other_m, n, other_n)
    return (100 + percent) * most >= percent * (F.col(n) + F.col(other_n))


def links(docs: DataFrame, classes: DataFrame, words: int, percent: int, made: list[DataFrame],
          text: str = "text") -> DataFrame:
    """``(node, component)`` of the classes that are linked with another."""
    prefix = written(postings(classes, percent, made), "postings", made)
    suspects = prefix.select("node").distinct().join(classes.select("node", "rep", "name"), "node")
    sets = written(full_sets(docs, suspects, words, text), "sets", made)
    lists = written(prefix.join(common_shingles(sets), "node").where(
        100 * F.col("m") >= percent * F.col("n")), "lists", made)
    signs = classes.select("node", "signature")
    found = None
    for _ in range(ROUNDS):
        pairs = _to_pivots(_placed(lists, found), percent)
        more = written(_confirmed(pairs, signs, sets, percent, made), "links", made)
        found = components(more, found)
        made.append(found)
    more = written(_in_tiles(_placed(lists, found), signs, sets, percent, made), "links", made)
    found = components(more, found)
    made.append(found)
    return found


def _placed(lists: DataFrame, found: DataFrame | None) -> DataFrame:
    """Postings with the component ``at`` of each class so far."""
    if found is None:
        return lists.withColumn("at", F.col("node"))
    return lists.join(found, "node", "left").select(
        "token", "node", "n", "m", F.coalesce("component", "node").alias("at"))


def _to_pivots(now: DataFrame, percent: int) -> DataFrame:
    """For each class, the pivot with which it shares most postings."""
    central = F.struct((F.col("m") / F.col("n")).alias("share"), "node", "n", "m", "at")
    pivots = now.groupBy("token").agg(
        F.max(central).alias("p"), F.min("at").alias("low"), F.max("at").alias("high")).where("low <> high").select(
        "token", F.col("p.node").alias("pivot"), F.col("p.n").alias("pn"), F.col("p.m").alias("pm"),
        F.col("p.at").alias("pat"))
    met = now.join(pivots, "token").where((F.col("at") != F.col("pat")) & _may_link("n", "m", "pn", "pm", percent))
    counted = met.groupBy("node", "pivot").agg(F.count("*").alias("hits"))
    best = counted.groupBy("node").agg(F.max(F.struct("hits", "pivot")).alias("best"))
    return best.select(F.least("node", "best.pivot").alias("a"),
                       F.greatest("node", "best.pivot").alias("b")).distinct()


def _in_tiles(now: DataFrame, signs: DataFrame, sets: DataFrame, percent: int,
              made: list[DataFrame]) -> DataFrame:
    """Links between components that still share a posting."""
    parted = now.groupBy("token").agg(
        F.min("node").alias("least"), F.min("at").alias("low"), F.max("at").alias("high")).where("low <> high")
    play = written(now.join(parted, "token").select("node", "least", "n", "m", "at"), "in-play", made)
    ties = play.select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()
    cluster = components(ties)
    made.append(cluster)
    nodes = play.select("node", "n", "m", "at").distinct().join(cluster, "node")
    size = cluster.groupBy("component").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    tiled = nodes.join(size, "component").withColumn(
        "tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    full = tiled.join(signs, "node").join(sets.select("node", "hashes"), "node")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    meets = full.withColumn("other", other).select(
        "component", F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi"),
        "tile", "node", "n", "m", "at", "signature", "hashes")
    return meets.groupBy("component", "lo", "hi").applyInPandas(
        lambda rows: _tile_links(rows, percent), "a long, b long")


def _tile_links(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Confirmed links between two tiles (or within one), enough to connect what they connect."""
    same = rows["lo"].iloc[0] == rows["hi"].iloc[0]
    left = rows if same else rows[rows["tile"] == rows["lo"]]
    right = rows if same else rows[rows["tile"] == rows["hi"]]
    out: list[tuple[int, int]] = []
    least = matches(percent)
    if len(left) and len(right):
        top = dict(zip(rows["at"], rows["at"]))

        def root(x: int) -> int:
            while top[x] != x:
                top[x] = top[top[x]]
                x = top[x]
            return x

        signs = np.stack(right["signature"].to_numpy())
        n, m, at = (right[c].to_numpy() for c in ("n", "m", "at"))
        nodes, hashes = right["node"].to_numpy(), right["hashes"].to_numpy()
        for one in left.itertuples():
            most = np.minimum(np.minimum(m, n), min(one.m, one.n))
            may = (at != one.at) & ((100 + percent) * most >= percent * (n + one.n))
            if same:
                may &= nodes > one.node
            near = np.flatnonzero(may)
            hits = (signs[near] == one.signature).sum(axis=1)
            for k in near[hits >= least][np.argsort(-hits[hits >= least], kind="stable")]:
                if root(one.at) == root(at[k]):
                    continue
                both = len(np.intersect1d(one.hashes, hashes[k], assume_unique=True))
                if 100 * both >= percent * (one.n + n[k] - both):
                    out.append((min(one.node, nodes[k]), max(one.node, nodes[k])))
                    top[root(one.at)] = root(at[k])
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def connect(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row."""
    made: list[DataFrame] = []
    rows = written(signatures(docs, words, text), "signatures", made)
    named = rows.where(F.col("name").isNotNull() & F.col("doc_id").isNotNull())
    classes = written(named.groupBy("name").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("signature").alias("signature"))
        .withColumn("node", F.monotonically_increasing_id()), "classes", made)
    found = links(docs, classes, words, percent, made, text)
    placed = classes.select("node", "name", "rep").join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    least = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_name = placed.join(least, "component").select("name", "component_id")
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), "name").join(by_name, "name", "left")
    own = F.coalesce("component_id", "doc_id")
    result = written(out.select("doc_id", "n_shingles", own.alias("component_id"),
                                F.coalesce(own == F.col("doc_id"), F.lit(True)).alias("kept")), "near-duplicates")
    discard(*made)
    return result


def deduplicate(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the least of its component; equal rows once."""
    kept = connect(docs, words, percent, text).where(F.col("kept") & F.col("doc_id").isNotNull())
    ids = written(kept.groupBy("doc_id").agg(F.count("*").alias("rows")), "kept")
    once, often = ids.where("rows = 1").select("doc_id"), ids.where("rows > 1").select("doc_id")
    # only ids that stand in several rows need a look at the text
    return (docs.join(once, "doc_id", "left_semi")
            .union(docs.join(often, "doc_id", "left_semi").dropDuplicates(["doc_id", text]))
            .union(docs.where(F.col("doc_id").isNull())))
