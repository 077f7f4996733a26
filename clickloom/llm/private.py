"""Personal data: candidate spans, scored by gradient-boosted trees (native functions only).

1. Base rules find e-mail addresses, IP addresses, card and phone numbers; spans that fail their
   check (parts up to 255, 13 to 19 digits and Luhn, 9 to 15 digits) are dropped without a retry.
2. Generators with high recall propose further, overlapping spans: any run of digits with the
   usual separators, and addresses in which the signs are spelt out.
3. Boosted trees score a candidate by its format (digits, groups, signs, check digit, shape) and by
   the characters and key words around it. They learn from all candidates: base spans are positive,
   also in the looser forms in which people write them (made from them by replacing separators,
   prefixes and signs); all other candidates are negative. Features are whole numbers in fixed bins,
   so candidates with equal features are one row with their number as its weight.
4. The threshold is the least score above which ``PRECISION`` of all candidates is positive, each half of
   them scored by trees that learnt from the other; the trees in use learn from both. Candidates above it are
   added where they do not touch a base span; of overlapping ones the surest stays. Base spans always stay.

Offsets count code points. Matching splits each text by the pattern: the pieces between matches
give the offsets, so no text leaves its row. Only candidates move, and only to their own row.

Defined results: missing text is empty; a text without findings has no spans; repeated rows get
equal results each; an empty table, or one without any candidate, gives no added spans. Extra
columns are kept by ``redact`` and ``find``; those named like a result column are replaced.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .text import text_of

# Kinds in their order, and the base patterns in a form that never backtracks into
# what a part has matched, with equal matches.
KINDS = ("email", "ip", "card", "phone")
BASE = {
    # a match starts where a run does or where the last one ended (\G): other starts in the run end alike
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a pattern to have a match; cheaper than the pattern.
SIGNS = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}",
         "phone": r"\+[0-9]"}
MORE = {
    # of a chain of very many digits only the end is looked at: a start never scans far
    "number": r"(?<![\p{L}\p{N}_])[+(]{0,2}[0-9](?:[\x20().-]{0,2}[0-9]){6,40}+"
              r"(?![\p{L}\p{N}_]|[\x20().-]{0,2}[0-9])",
    "digits": r"(?<![\p{L}\p{N}_])[0-9]{7,19}+(?![\p{L}\p{N}_])",
    "address": r"(?i)(?:(?<![a-z0-9._%+-])|\G)[a-z0-9._%+-]++(?:@|\x20?[\[(<]\x20?at\x20?[\])>]\x20?|\x20at\x20)[a-z0-9-]++"
               r"(?:(?:\.|\x20?[\[(<]\x20?dot\x20?[\])>]\x20?|\x20dot\x20)[a-z0-9-]++)++",
}
AROUND = 24  # characters of context on either side
PRECISION = 0.99
# Features up to the first edge have a bin for each number, larger ones share a bin between two edges.
EDGES = (24, 28, 32, 40, 48, 64)
N_BINS = EDGES[0] + len(EDGES) + 1
# Spark ML finds its cuts in this many rows, or in the square of ``maxBins`` where that is more.
DRAWN = 10_000
PART = 100_000  # rows of equal features in one task
TREES, DEPTH = 12, 3
WORDS = {
    "phone": r"(?i)\b(?:tel|phone|call|mobile|fax|cell)\b", "card": r"(?i)\b(?:card|visa|credit|iban)\b",
    "ip": r"(?i)\b(?:ip|host|server|address)\b", "email": r"(?i)\b(?:mail|email|e-mail|contact)\b",
}
# Columns of its own, while rows are on their way.
ROW, KEY, BASE_SPANS, MORE_SPANS, ADDED, CHOSEN = (f"__pii_{c}" for c in ("row", "key", "base", "more", "added", "chosen"))
FEATURES = ["n_chars", "n_digits", "n_groups", "n_separators", "first_group", "last_group", "longest_group",
            "plus", "parenthesis", "dots", "dashes", "blanks", "at_sign", "spelt", "luhn", "octets",
            "letter_before", "letter_after", "digit_near", "quote_near",
            *[f"word_{k}" for k in WORDS]]


def matches(text: Column, pattern: str, guard: str | None = None) -> Column:
    """``array<struct<s, e, v>>``: every match with its code point offsets, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    empty = F.lit(0).cast("int")
    start = F.struct(empty.alias("p"), F.expr("cast(array() as array<struct<s:int,e:int,v:string>>)").alias("out"))

    def step(state: Column, x: Column) -> Column:
        s = state["p"] + F.char_length(x["gap"])
        e = s + F.char_length(x["v"])
        one = F.struct(s.alias("s"), e.alias("e"), x["v"].alias("v"))
        return F.struct(e.alias("p"), F.concat(state["out"], F.array(one)).alias("out"))

    pairs = F.zip_with(found, F.slice(between, F.lit(1), F.size(found)),
                       lambda v, gap: F.struct(v.alias("v"), gap.alias("gap")))
    spans = F.aggregate(pairs, start, step, lambda state: state["out"])
    none = F.expr("cast(array() as array<struct<s:int,e:int,v:string>>)")
    return F.when(text.rlike(guard or pattern), spans).otherwise(none)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of ``value`` pass the Luhn check."""
    backwards = F.split(F.reverse(digits(value)), "")
    ones = F.filter(backwards, lambda c: c != "")
    worth = F.transform(ones, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        (c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(worth, F.lit(0), lambda a, b: a + b) % 10 == 0


def octets(value: Column) -> Column:
    """Whether every run of digits is at most 255."""
    part = lambda p: F.regexp_replace(p, "^0+(?=.)", "")
    return F.forall(F.filter(F.split(value, "[^0-9]+"), lambda p: p != ""), lambda p: (
        F.char_length(part(p)) < 3) | ((F.char_length(part(p)) == 3) & (part(p) <= "255")))


def _valid(kind: str, value: Column) -> Column:
    n = F.char_length(digits(value))
    return {"email": F.lit(True), "ip": octets(value), "card": n.between(13, 19) & luhn(value),
            "phone": n.between(9, 15)}[kind]


def base_spans(text: Column) -> Column:
    """``array<struct<k, s, e>>`` of base spans, ``k`` being the place of the kind in ``KINDS``."""
    def of(k: int, kind: str) -> Column:
        found = matches(text, BASE[kind], SIGNS[kind])
        good = F.filter(found, lambda x: _valid(kind, x["v"]))
        return F.transform(good, lambda x: F.struct(F.lit(k).alias("k"), x["s"].alias("s"), x["e"].alias("e")))

    return F.concat(*[of(k, kind) for k, kind in enumerate(KINDS)])


def _candidates(text: Column) -> Column:
    """``array<struct<s, e, v, before, after>>`` of all proposals with their context."""
    every = F.concat(*[matches(text, p) for p in MORE.values()])
    return F.transform(every, lambda x: F.struct(
        x["s"].alias("s"), x["e"].alias("e"), x["v"].alias("v"),
        F.substring(text, F.greatest(x["s"] - AROUND, F.lit(0)) + 1,
                    F.least(x["s"], F.lit(AROUND))).alias("before"),
        F.substring(text, x["e"] + 1, F.lit(AROUND)).alias("after")))


def features(df: DataFrame) -> DataFrame:
    """Format and context features of ``v``, ``before`` and ``after``."""
    v = F.col("v")
    count = lambda p: F.regexp_count(v, F.lit(p)).cast("double")
    yes = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    runs = F.filter(F.split(v, "[^0-9]+"), lambda p: p != "")
    near = F.concat_ws(" ", "before", "after")
    length = lambda c: F.coalesce(F.char_length(c), F.lit(0)).cast("double")
    made = {
        "n_chars": length(v), "n_digits": length(digits(v)), "n_groups": F.size(runs).cast("double"),
        "n_separators": count(r"[^0-9A-Za-z]"), "first_group": length(F.get(runs, F.lit(0))),
        "last_group": length(F.get(runs, F.size(runs) - 1)),
        "longest_group": F.coalesce(F.array_max(F.transform(runs, lambda r: F.char_length(r))), F.lit(0)).cast("double"),
        "plus": yes(v.startswith("+")), "parenthesis": count(r"[()]"), "dots": count(r"\."),
        "dashes": count("-"), "blanks": count(r"\x20"), "at_sign": count("@"),
        "spelt": count(r"(?i)\b(?:at|dot)\b"), "luhn": yes(luhn(v)), "octets": yes(octets(v)),
        "letter_before": yes(F.col("before").rlike(r"[\p{L}\p{N}_]$")),
        "letter_after": yes(F.col("after").rlike(r"^[\p{L}\p{N}_]")),
        "digit_near": yes(near.rlike("[0-9]")), "quote_near": yes(near.rlike(r"[\"'=]")),
        **{f"word_{k}": yes(near.rlike(p)) for k, p in WORDS.items()},
    }
    return df.withColumns(made)


def _looser(positives: DataFrame) -> DataFrame:
    """Base spans as people also write them: without the plus or country code, with signs spelt out,
    with other separators."""
    v, forms = F.col("v"), []
    is_phone, is_mail = v.startswith("+"), v.contains("@")
    is_ip = v.rlike(r"^[0-9]+(?:\.[0-9]+){3}$")
    forms.append(F.when(is_phone, F.regexp_replace(v, r"^\+[0-9]+[\x20.-]", "")))
    forms.append(F.when(is_phone, F.regexp_replace(v, r"^\+", "00")))
    forms.append(F.when(is_mail, F.regexp_replace(F.regexp_replace(v, "@", " at "), r"\.", " dot ")))
    forms.append(F.when(is_mail, F.regexp_replace(F.regexp_replace(v, "@", " [at] "), r"\.", " [dot] ")))
    forms.append(F.when(~is_phone & ~is_mail & ~is_ip,
                        F.rtrim(F.regexp_replace(digits(v), "([0-9]{4})", "$1."), F.lit("."))))
    return (positives.select("*", F.explode(F.array(*forms)).alias("w")).where(F.col("w").isNotNull())
            .drop("v").withColumnRenamed("w", "v"))


def binned(df: DataFrame) -> DataFrame:
    """``df`` with the bins of ``FEATURES``, from 0 to ``N_BINS`` - 1."""
    made = features(df)
    more = lambda c: sum((F.col(c) > e).cast("double") for e in EDGES)
    return made.withColumns({c: F.least(F.col(c), F.lit(float(EDGES[0]))) + more(c) for c in FEATURES})


def assembled(df: DataFrame, learning: bool) -> DataFrame:
    """Bins as the vector ``features``; for ``learning`` beside what trees learn from, and nothing else."""
    made = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)
    return made.select("features", "label", "held", F.col("n").cast("double").alias("n")) if learning else made


def most_bins(n: int) -> int:
    """``maxBins`` for ``n`` rows: room for every bin, and so much that Spark ML finds its cuts in all rows, not in
    some. There are no more cuts than bins with rows."""
    return max(N_BINS + 1, 1 + math.isqrt(n) if n > DRAWN else 0)


def examples(candidates: DataFrame) -> DataFrame:
    """Bins, ``label``, ``held`` and ``n``, the number of candidates alike: all there are, and their looser forms."""
    # halves by text and place: the same however the rows are dealt
    hashed = F.xxhash64(F.pmod(F.xxhash64("key", "s", "e"), F.lit(2**30)))
    taken = candidates.select("v", "before", "after", "label", (F.pmod(hashed, F.lit(2)) == 0).alias("held"))
    both = taken.unionByName(_looser(taken.where("label = 1")))
    return binned(both).groupBy(*FEATURES, "label", "held").agg(F.count(F.lit(1)).alias("n"))


def train(candidates: DataFrame) -> tuple[GBTClassificationModel, float] | None:
    """Trees and threshold from all ``candidates``.

    Both classes must occur; otherwise there is nothing to learn and nothing is added.
    """
    alike = written(examples(candidates), "pii-examples")
    told = alike.groupBy("label", "held").agg(F.count(F.lit(1)).alias("n")).collect()  # four rows at most
    if len(told) < 4:
        return None
    n = sum(r["n"] for r in told)
    # in a fixed order, so that the trees are the same in every run
    ordered = alike.repartition(1 + n // PART, *FEATURES).sortWithinPartitions(*FEATURES, "label", "held")
    rows = written(assembled(ordered, True), "pii-rows")
    # bins are numbers in their order, and every cut between two of them is tried, however many rows there are
    boosted = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=3, maxBins=most_bins(n), stepSize=0.3, weightCol="n")
    halves = [rows.where("held"), rows.where("not held")]
    judged = boosted.fit(halves[1]).transform(halves[0]).unionAll(boosted.fit(halves[0]).transform(halves[1]))
    score = F.floor(vector_to_array("probability")[1] * 200) / 200
    bins = judged.groupBy(score.alias("score")).agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("good"))  # 201 rows at most
    above = Window.orderBy(F.desc("score"))
    good = bins.select("score", (F.sum("good").over(above) / F.sum("n").over(above)).alias("precision")).where(
        F.col("precision") >= PRECISION)
    least = good.agg(F.min("score").alias("least")).first()["least"]
    return None if least is None else (boosted.fit(rows), float(least))


def _number_of(k: int) -> Column:
    return F.size(F.filter(BASE_SPANS, lambda x: x["k"] == k)).cast("long")


def _joined(spans: Column) -> Column:
    name = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(F.sort_array(spans), lambda x: F.concat_ws(
        ":", F.get(name, x["k"]), x["s"].cast("string"), x["e"].cast("string"))))


def _kind_of(v: Column) -> Column:
    """The kind of an added span, by its format."""
    n = F.char_length(digits(v))
    return (F.when(v.rlike(r"[A-Za-z@]"), 0)
            .when(v.rlike(r"^[0-9]+(?:\.[0-9]+){3}$") & octets(v), 1)
            .when(n.between(13, 19) & luhn(v), 2).when(n.between(7, 15), 3))


def find(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Add ``n_email, n_ip, n_card, n_phone`` (base spans), ``base_sha256``, ``spans`` and
    ``found``, the spans as an array of (k, s, e)."""
    body = text_of(text)
    out = docs.withColumns({BASE_SPANS: base_spans(body), MORE_SPANS: _candidates(body), KEY: F.xxhash64(body)})
    if not keep_text:
        out = out.drop(text)
    scanned = written(out.withColumn(ROW, F.monotonically_increasing_id()), "pii")
    # judged in their row: base spans are not repeated for each candidate
    touches = lambda c: F.exists(BASE_SPANS, lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"]))
    equal = lambda c: F.exists(BASE_SPANS, lambda b: (b["s"] == c["s"]) & (b["e"] == c["e"]))
    judged = F.transform(MORE_SPANS, lambda c: F.struct(
        *[c[f].alias(f) for f in ("s", "e", "v", "before", "after")],
        equal(c).cast("double").alias("label"), touches(c).alias("touches")))
    labelled = scanned.select(F.col(ROW).alias("row"), F.col(KEY).alias("key"), F.explode(judged).alias("c")).select(
        "row", "key", "c.*")
    # what only touches a base span teaches nothing
    learnt = train(labelled.where("label = 1 or not touches"))
    none = F.expr("cast(array() as array<struct<k:int,s:int,e:int>>)")
    if learnt is None:
        met = scanned.withColumn(ADDED, none)
    else:
        model, least = learnt
        fresh = assembled(binned(labelled.where("not touches")), False)
        scored = model.transform(fresh).where(vector_to_array("probability")[1] >= least)
        ranked = F.struct(vector_to_array("probability")[0].alias("doubt"), "s", "e", _kind_of(F.col("v")).alias("k"))
        chosen = scored.where(_kind_of(F.col("v")).isNotNull()).groupBy(F.col("row").alias(ROW)).agg(
            F.sort_array(F.collect_set(ranked)).alias(CHOSEN))
        met = scanned.join(chosen, ROW, "left").withColumn(ADDED, F.coalesce(_apart(CHOSEN), none)).drop(CHOSEN)
    n = {f"n_{kind}": _number_of(k) for k, kind in enumerate(KINDS)}
    return met.withColumns({
        **n, "base_sha256": F.sha2(_joined(F.col(BASE_SPANS)), 256),
        "spans": _joined(F.concat(BASE_SPANS, ADDED)),
        "found": F.sort_array(F.concat(BASE_SPANS, ADDED))}).drop(BASE_SPANS, MORE_SPANS, ROW, ADDED, KEY)


def _apart(column: str) -> Column:
    """Of overlapping spans the surest, then the leftmost."""
    none = F.expr("cast(array() as array<struct<k:int,s:int,e:int>>)")

    def step(out: Column, x: Column) -> Column:
        clash = F.exists(out, lambda o: (o["s"] < x["e"]) & (x["s"] < o["e"]))
        one = F.struct(x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e"))
        return F.when(clash, out).otherwise(F.concat(out, F.array(one)))

    return F.aggregate(column, none, step)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every found span replaced by its kind in angle brackets."""
    found = find(docs, text)
    name = F.array(*map(F.lit, KINDS))
    by_start = F.sort_array(F.transform("found", lambda x: F.struct(
        x["s"].alias("s"), x["e"].alias("e"), x["k"].alias("k"))))
    start = F.struct(F.lit(0).alias("p"), F.expr("cast(array() as array<string>)").alias("out"))

    def step(a: Column, x: Column) -> Column:
        # spans of different kinds may overlap: what is left of the second is replaced too
        cut = F.substring(F.col(text), a["p"] + 1, F.greatest(x["s"] - a["p"], F.lit(0)))
        mark = F.when(x["e"] > a["p"], F.concat(F.lit("<"), F.get(name, x["k"]), F.lit(">"))).otherwise("")
        return F.struct(F.greatest(a["p"], x["e"]).alias("p"),
                        F.concat(a["out"], F.array(cut, mark)).alias("out"))

    changed = F.aggregate(by_start, start, step, lambda a: F.concat(
        F.array_join(a["out"], ""), F.substring(F.col(text), a["p"] + 1, F.char_length(text))))
    clean = F.when(F.size("found") > 0, changed).otherwise(F.col(text))
    return found.withColumn(text, clean).select(*docs.columns)
