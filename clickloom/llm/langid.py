"""Language identification by compression with per-language dictionaries.

``fit`` gathers, for every language, ``PIECES`` different pieces of labelled texts, those with the smallest hash
of language and piece, until they fill ``DICTIONARY`` bytes; they are a raw-content dictionary for zstandard.
That sample is bounded by these two parameters, however many rows a language has.

``identify`` normalizes a text (letters in lower case, everything else a blank), cuts the whole of it into
stretches of ``STRETCH`` letters, and encodes each with every language's dictionary. The sum of the sizes
decides: a stretch is too short to learn a language by itself, so what helps is what the dictionary knows,
however long the text is. The smallest sum wins; ties, as very short texts have, go to the language with
more labelled rows, then by name.

The margin is how much smaller the best sum is than the second, as a share of the second. Below ``MARGIN`` the
answer is rejected: ``lang`` is missing then, while ``lang_pred`` keeps the best guess. ``score`` is 1 / (1 + 2^-x),
where x grows by one with each ``STEP`` of margin; 0 without an answer.

Defined results: texts that are missing or without a letter are ``und`` with score 0; so are all texts when
nothing was learnt. One language learnt: it is the answer to every text, with score 1. Repeated rows get
equal results; labelled rows without letters teach nothing; an empty table gives an empty table.
Languages together may fill ``MODEL_BYTES``; more of them raise an error. Existing result columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import slices

UNKNOWN = "und"
PIECES = 240  # pieces of text in a language's dictionary
PIECE = 160  # letters of a piece
DICTIONARY = 32_000  # bytes of a dictionary
MODEL_BYTES = 64_000_000
STRETCH = 600  # letters encoded at once
LEVEL = 6
MARGIN = 0.01
STEP = 0.01


def letters(text: Column) -> Column:
    """Lower-case letters with single blanks between runs of them."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " "))


def is_held_out(doc_id: Column) -> Column:
    """Documents that teach nothing: a third of the ids by checksum."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def sample(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``(lang, piece, rank)``: ``PIECES`` different pieces per language, those with the smallest hashes."""
    labelled = docs.select(F.col(lang).cast("string").alias("lang"), letters(F.col(text)).alias("letters")).where(
        F.col("lang").isNotNull() & (F.col("letters") != ""))
    # one piece of each text, at a place drawn from the text itself
    at = F.pmod(F.xxhash64("letters"), F.greatest(F.char_length("letters") - PIECE, F.lit(0)) + 1)
    pieces = labelled.select("lang", F.substring("letters", (at + 1).cast("int"), F.lit(PIECE)).alias("piece"))
    # each piece once, so that copies of a text do not fill a dictionary
    first = Window.partitionBy("lang").orderBy(F.xxhash64("lang", "piece"), "piece")
    return pieces.distinct().withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= PIECES)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, bytes]:
    """The dictionary of every language, the one with most labelled rows first.

    Comes to the driver: ``DICTIONARY`` bytes per language, as many as ``MODEL_BYTES`` hold.
    """
    rows = docs.where(F.col(lang).isNotNull()).groupBy(F.col(lang).cast("string").alias("lang")).count()
    most = MODEL_BYTES // DICTIONARY
    order = rows.orderBy(F.desc("count"), "lang").limit(most + 1).collect()
    if len(order) > most:
        raise ValueError(f"more than {most} languages do not fit into {MODEL_BYTES} bytes")
    grouped: dict[str, list] = {}
    for row in sample(docs, text, lang).collect():
        grouped.setdefault(row["lang"], []).append((row["rank"], row["piece"]))
    return {r["lang"]: " ".join(p for _, p in sorted(grouped[r["lang"]])).encode()[:DICTIONARY]
            for r in order if r["lang"] in grouped}


class Classifier:
    """Sizes of a text under each language's dictionary."""

    def __init__(self, model: dict[str, bytes], level: int = LEVEL) -> None:
        import zstandard

        self.names = list(model)
        self.encoders = []
        for name in self.names:
            known = zstandard.ZstdCompressionDict(model[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=level)
            self.encoders.append(zstandard.ZstdCompressor(
                dict_data=known, write_checksum=False, write_content_size=False, write_dict_id=False).compress)

    def sizes(self, text: str) -> list[int]:
        # a last stretch of a few letters goes with the one before
        stops = list(range(STRETCH, max(len(text) - STRETCH // 2, 1), STRETCH))
        parts = [text[i:j].encode() for i, j in zip([0, *stops], [*stops, len(text)])]
        return [sum(len(encode(p)) for p in parts) for encode in self.encoders]

    def of(self, text: str) -> tuple[str, float]:
        """The best language and the margin to the second."""
        if len(self.names) == 1:
            return self.names[0], 1.0
        sizes = self.sizes(text)
        best, second = sorted(range(len(sizes)), key=lambda i: (sizes[i], i))[:2]
        return self.names[best], 1 - sizes[best] / sizes[second]


def identify(docs: DataFrame, model: dict[str, bytes], text: str = "text", margin: float = MARGIN) -> DataFrame:
    """``docs`` without the text, with ``lang_pred``, ``score``, ``margin`` and ``lang`` (missing if rejected)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(model) if model else None
        for batch in batches:
            for part in slices(pa.Table.from_batches([batch]).to_batches()):
                rows = [classifier.of(t) if t and classifier else (UNKNOWN, None) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array([r[0] for r in rows], pa.string()),
                     pa.array([r[1] for r in rows], pa.float64())],
                    [*part.schema.names[1:], "lang_pred", "margin"])

    rest = [c for c in docs.columns if c not in (text, "lang_pred", "margin", "score", "lang")]
    cells = docs.select(letters(F.col(text)).alias("_letters"), *rest)
    kept = cells.schema.fields[1:]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], "lang_pred string", "margin double"])
    told = cells.mapInArrow(run, schema)
    score = F.when(F.col("margin").isNull(), 0.0).when(F.col("margin") >= 1, 1.0).otherwise(
        1 / (1 + F.pow(F.lit(2.0), -F.col("margin") / STEP)))
    return told.withColumn("score", score).withColumn(
        "lang", F.when(F.col("margin") >= margin, F.col("lang_pred")))
