"""Quality rules with thresholds learnt per language and source (native functions only).

``measure`` counts, in one pass over each text and without a shuffle:

* ``n_words``, ``word_chars`` (code points in words), ``n_symbols``;
* ``n_dup_lines``: lines with a word that equal an earlier line of the text;
* ``n_repeat_words``: words inside three-word windows that occur twice or more in the text,
  the first occurrence included. Windows are compared by a 64-bit hash within one text.

``thresholds`` builds one mergeable KLL sketch per measure, language and source. Sketches of small
groups are merged with those of the whole language, then of the whole table, so a limit always
rests on enough texts. A limit is the upper quartile plus a multiple of the quartile distance; the
distance is at least ``Rule.spread``, so that a group in which a measure hardly varies does not
reject ordinary texts. ``judge`` joins the limits and decides.

A KLL sketch of more values than it holds keeps a random part of them, so its quartiles are off by some ranks
(about 0.5 %). They only tell between which values a quartile lies: the texts below and between those are
counted, and the quartile is the value at its exact rank. ``limit_level`` tells whether a
group's limits rest on itself, its language or the whole table.

Defined results: if no text passes the base rules there are no limits, and none is kept; missing text counts as empty and fails the base rules; missing language or source
is a group of its own; repeated rows each get a result; an empty table gives an empty table. Extra
columns pass through unchanged unless they bear the name of a result column, which replaces them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .text import text_of, words_of

# Symbols counted by the base rules, and the base limits.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """Reject a text whose ``measure`` exceeds the upper quartile by ``factor`` distances."""

    name: str
    spread: float  # least quartile distance
    factor: float = 3.0

    @property
    def measure(self) -> Column:
        return {
            "symbols_per_word": F.col("n_symbols") / F.col("n_words"),
            "repeat_share": F.col("n_repeat_words") / F.col("n_words"),
            "dup_lines_per_word": F.col("n_dup_lines") / F.col("n_words"),
            "word_length": F.col("word_chars") / F.col("n_words"),
        }[self.name]


RULES = (
    Rule("symbols_per_word", spread=0.03),
    Rule("repeat_share", spread=0.15),
    Rule("dup_lines_per_word", spread=0.02),
    Rule("word_length", spread=1.0),
)
GROUP = ("lang", "source")
MIN_GROUP = 200  # texts behind a limit before the group stands for itself
SKETCH_K = 400  # size of a sketch: rank error about 0.5 %
MARGIN = 0.03  # ranks on either side of a sketched quartile that are counted, as a share of all
QUARTILES = (0.25, 0.75)
SCOPE = ("limit_level", "__q_of_lang", "__q_of_source")  # the texts that a limit rests on


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the base counts (long) and ``base_failed``."""
    out = docs.drop(*COUNTS, "base_failed").withColumn("__q_words", words_of(text_of(text)))
    out = out.withColumn("__q_hash", F.transform("__q_words", lambda w: F.xxhash64(w)))
    out = out.withColumn("__q_keys", F.transform(
        F.slice("__q_hash", 1, F.greatest(F.size("__q_hash") - 2, F.lit(0))),
        lambda h, i: F.xxhash64(h, F.get("__q_hash", i + 1), F.get("__q_hash", i + 2))))
    # most texts repeat no window; only the others are sorted
    out = out.withColumn("__q_sorted", F.when(
        F.size("__q_keys") > F.size(F.array_distinct("__q_keys")),
        F.sort_array(F.transform("__q_keys", lambda k, i: F.struct(k.alias("k"), i.alias("i"))))))
    same = lambda x, j: F.coalesce(x["k"] == F.get("__q_sorted", j)["k"], F.lit(False))
    out = out.withColumn("__q_at", F.sort_array(F.filter(
        F.transform("__q_sorted", lambda x, j: F.when(same(x, j - 1) | same(x, j + 1), x["i"])),
        lambda i: i.isNotNull())))
    # a window covers three words, fewer where the next repeated window begins inside it
    covered = F.aggregate(
        F.transform("__q_at", lambda i, j: F.least(F.lit(3), F.get("__q_at", j + 1) - i)),
        F.lit(0), lambda a, b: a + b)
    lines = F.filter(F.split(text_of(text), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = out.withColumn("__q_lines", lines)
    counts = {
        "n_words": F.size("__q_words"),
        "word_chars": F.aggregate("__q_words", F.lit(0), lambda a, w: a + F.char_length(w)),
        "n_symbols": F.char_length(F.regexp_replace(text_of(text), f"[^{SYMBOLS}]+", "")),
        "n_dup_lines": F.size("__q_lines") - F.size(F.array_distinct("__q_lines")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)),
    }
    out = out.withColumns({name: c.cast("long") for name, c in counts.items()})
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    return out.withColumn("base_failed", failed).drop(
        "__q_words", "__q_hash", "__q_keys", "__q_sorted", "__q_at", "__q_lines")


def _group(names=GROUP) -> list[Column]:
    return [F.coalesce(F.col(n).cast("string"), F.lit("\0")).alias(f"__q_{n}") for n in names]


def thresholds(measured: DataFrame, rules=RULES, min_group: int = MIN_GROUP) -> DataFrame:
    """One row per (language, source) with a limit for each rule.

    Only texts that pass the base rules are sketched. Grouping shrinks on the map side: a task
    sends one sketch per group, however many rows the group has.
    """
    # a filter would be pushed below the counts and compute them once more: nulls do the same
    good = measured.select(*_group(), *[
        F.when(~F.col("base_failed"), r.measure).alias(r.name) for r in rules])
    per_group = good.groupBy("__q_lang", "__q_source").agg(
        F.count(rules[0].name).alias("n"),
        *[F.kll_sketch_agg_double(r.name, SKETCH_K).alias(r.name) for r in rules])
    merged = [F.kll_merge_agg_double(r.name, SKETCH_K).alias(f"{r.name}_all") for r in rules]
    per_lang = per_group.groupBy("__q_lang").agg(F.sum("n").alias("n_lang"), *merged)
    whole = per_lang.agg(F.sum("n_lang").alias("n_whole"), *[
        F.kll_merge_agg_double(f"{r.name}_all", SKETCH_K).alias(f"{r.name}_whole") for r in rules])
    joined = per_group.join(per_lang, "__q_lang").crossJoin(F.broadcast(whole))  # whole: one row

    def of_level(group, lang, whole):
        return F.when(F.col("n") >= min_group, group).when(F.col("n_lang") >= min_group, lang).when(
            F.col("n_whole") > 0, whole)

    def bracket(r: Rule, q: float) -> Column:
        sketch = of_level(F.col(r.name), F.col(f"{r.name}_all"), F.col(f"{r.name}_whole"))
        # an empty sketch has no quantile: asking for one is an error
        low, high = (F.when(F.col("n_whole") > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(x)))
                     for x in (max(q - MARGIN, 0.0), min(q + MARGIN, 1.0)))
        return F.struct(low.alias("low"), high.alias("high"))

    items = [(r, q) for r in rules for q in QUARTILES]
    groups = written(joined.select(
        "__q_lang", "__q_source", of_level(F.lit("group"), F.lit("language"), F.lit("table")).alias("limit_level"),
        of_level(F.col("__q_lang"), F.col("__q_lang"), F.lit("")).alias("__q_of_lang"),
        of_level(F.col("__q_source"), F.lit(""), F.lit("")).alias("__q_of_source"),
        of_level(F.col("n"), F.col("n_lang"), F.col("n_whole")).alias("__q_n"),
        F.array(*[bracket(r, q) for r, q in items]).alias("__q_between")), "brackets")
    scopes = groups.where("limit_level is not null").select(*SCOPE, "__q_n", "__q_between").dropDuplicates(list(SCOPE))
    values = good.where(F.col(rules[0].name).isNotNull()).select("__q_lang", "__q_source", F.array(
        *[F.col(r.name) for r, _ in items]).alias("__q_values"))
    found = written(_quartiles(values, scopes, items), "quartiles")
    # the sketch was off by more than its margin: all values are counted
    missed = scopes.join(found.where(F.size("__q_at") == len(items)), list(SCOPE), "left_anti")
    if not missed.isEmpty():
        every = F.transform("__q_between", lambda _: F.struct(
            F.lit(float("-inf")).alias("low"), F.lit(float("inf")).alias("high")))
        again = _quartiles(values, missed.withColumn("__q_between", every), items)
        found = found.join(missed, list(SCOPE), "left_anti").unionByName(again)

    def limit(k: int, r: Rule) -> Column:
        low, high = (F.element_at("__q_at", F.lit(2 * k + j)) for j in (0, 1))
        return (high + r.factor * F.greatest(high - low, F.lit(r.spread))).alias(f"__q_limit_{r.name}")

    return groups.join(found, list(SCOPE), "left").select(
        "__q_lang", "__q_source", *[limit(k, r) for k, r in enumerate(rules)], "limit_level")


def _quartiles(values: DataFrame, scopes: DataFrame, items: list) -> DataFrame:
    """``__q_at``, per scope: the exact quartile of each item whose bracket holds it, by the item's place.

    Equal values are counted on the map side; what is sorted are the different values inside a bracket.
    """
    parts = []
    for level, keys in (("group", ["__q_lang", "__q_source"]), ("language", ["__q_lang"]), ("table", [])):
        own = scopes.where(F.col("limit_level") == level)
        named = own.withColumns({"__q_lang": F.col("__q_of_lang"), "__q_source": F.col("__q_of_source")}).drop(
            *{"__q_lang", "__q_source"} - set(keys))
        rows = values.join(named, keys) if keys else values.crossJoin(named)
        parts.append(rows.select(*SCOPE, "__q_n", F.posexplode(
            F.arrays_zip("__q_values", "__q_between")).alias("__q_item", "__q_x")))
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    x, low, high = F.col("__q_x.__q_values"), F.col("__q_x.__q_between.low"), F.col("__q_x.__q_between.high")
    counted = every.where(x <= high).groupBy(*SCOPE, "__q_n", "__q_item", F.when(x >= low, x).alias("__q_v")).agg(
        F.count(F.lit(1)).alias("__q_rows"))  # missing: below the bracket
    upwards = Window.partitionBy(*SCOPE, "__q_item").orderBy(F.asc_nulls_first("__q_v")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    q = F.element_at(F.array(*[F.lit(q) for _, q in items]), F.col("__q_item") + 1)
    rank = F.greatest(F.ceil(q * F.col("__q_n")), F.lit(1))
    upto = counted.withColumn("__q_upto", F.sum("__q_rows").over(upwards))
    met = upto.where((F.col("__q_upto") >= rank) & (F.col("__q_upto") - F.col("__q_rows") < rank)
                     & F.col("__q_v").isNotNull())  # one row per item
    at = met.groupBy(*SCOPE).agg(F.map_from_entries(F.collect_list(F.struct("__q_item", "__q_v"))).alias("__q_at"))
    return at


def judge(measured: DataFrame, limits: DataFrame, rules=RULES) -> DataFrame:
    """Add ``kept`` and ``limit_level``: false if the base rules fail or a measure is above its group's limit.

    A group without limits has no text that passes the base rules.
    """
    keyed = measured.drop("kept", "limit_level").withColumns(dict(zip(("__q_lang", "__q_source"), _group())))
    passed = ~F.col("base_failed")
    for r in rules:
        passed = passed & (r.measure <= F.col(f"__q_limit_{r.name}"))
    return (keyed.join(limits, ["__q_lang", "__q_source"], "left")
            .withColumn("kept", F.coalesce(passed, F.lit(False)))
            .drop("__q_lang", "__q_source", *[f"__q_limit_{r.name}" for r in rules]))


def rate(docs: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """Every row with its counts, ``base_failed`` and ``kept``.

    The counts are written once, since the limits rest on all of them; drop columns that are not
    needed later (the text, say) by ``keep_text=False``, so that they are not written with them.
    """
    measured = measure(docs, text)
    if not keep_text:
        measured = measured.drop(text)
    measured = written(measured, "quality")
    return judge(measured, written(thresholds(measured), "limits"))
