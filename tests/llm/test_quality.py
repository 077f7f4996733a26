import re
from collections import Counter

from clickloom.llm import quality


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered))


def test_counts_match_brute_force(docs_of, prose):
    texts = [None, "", " \t\n ", "one", "a b", "a b c", "a b c a b c", "x x x x x", "ü# **\x0b|<é>",
             "line one\nline one\n\n\nline one", "a b c d a b c\x0cd", prose(1, 5000), "w " * 3000]
    got = {r["doc_id"]: tuple(r[c] for c in quality.COUNTS) for r in quality.measure(docs_of(*texts)).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_base_rules(docs_of, prose):
    texts = ["few words only", prose(2, 49), prose(2, 50), "same same same " * 40]
    got = [r["base_failed"] for r in quality.measure(docs_of(*texts)).orderBy("doc_id").collect()]
    assert got == [True, True, False, True]


def test_learnt_limits_reject_junk_and_keep_prose(docs_of, prose):
    clean = [prose(i, 80) for i in range(30)]
    junk = " ".join(w + "***" for w in prose(99, 80).split())
    rated = quality.rate(docs_of(*clean, junk, clean[0])).collect()
    assert len(rated) == 32  # repeated rows stay
    assert {r["doc_id"] for r in rated if not r["kept"]} == {30}


def test_missing_groups_and_empty_table(spark, docs_of, prose):
    df = docs_of(prose(3, 60), None).withColumn("lang", quality.F.lit(None).cast("string"))
    kept = {r["doc_id"]: r["kept"] for r in quality.rate(df).collect()}
    assert kept == {0: True, 1: False}
    assert quality.rate(df.limit(0)).count() == 0


def test_clashing_column_is_replaced(docs_of, prose):
    df = docs_of(prose(4, 60)).withColumn("kept", quality.F.lit("mine")).withColumn("n_words", quality.F.lit(-1))
    (row,) = quality.rate(df).collect()
    assert row["kept"] is True and row["n_words"] == 60


def test_no_text_passes_the_base_rules(docs_of):
    (row,) = quality.rate(docs_of("a short text")).collect()
    assert row["kept"] is False and row["limit_level"] is None


def test_limits_do_not_change_between_reads(spark, docs_of, prose):
    many = docs_of(prose(5, 60)).select("text", "lang", "source").crossJoin(spark.range(3000)).select(
        quality.F.col("id").alias("doc_id"),
        quality.F.concat("text", quality.F.lit(" #"), quality.F.repeat(quality.F.lit("# "), (quality.F.col("id") % 40).cast("int"))).alias("text"),
        "lang", "source")
    rated = quality.rate(many)
    assert rated.select("doc_id", "kept").exceptAll(rated.select("doc_id", "kept")).isEmpty()
    assert {r["limit_level"] for r in rated.select("limit_level").distinct().collect()} == {"group"}


def test_columns_named_like_helpers_pass_through(docs_of, prose):
    names = ["_lang", "_words", "limit_word_length", "_at", "n"]
    df = docs_of(prose(6, 60)).withColumns({n: quality.F.lit(n) for n in names})
    (row,) = quality.rate(df).collect()
    assert [row[n] for n in names] == names and row["kept"] is True


def brute_limits(rows):
    """Limits of one group by exact quartiles: what the sketch gives while it holds every value."""
    import math

    out = {}
    for rule, measure in (("symbols_per_word", 2), ("repeat_share", 4), ("dup_lines_per_word", 3), ("word_length", 1)):
        values = sorted(r[measure] / r[0] for r in rows)
        low, high = (values[max(math.ceil(q * len(values)) - 1, 0)] for q in (0.25, 0.75))
        spread = next(r.spread for r in quality.RULES if r.name == rule)
        out[measure] = high + 3 * max(high - low, spread)
    return out


def test_kept_matches_brute_force(docs_of, prose):
    texts = [prose(i, 60 + i % 7) + " #" * (i % 23) for i in range(90)]
    rows = {i: brute(t) for i, t in enumerate(texts)}
    passing = {i: r for i, r in rows.items() if r[0] >= 50 and 100 * r[4] <= 50 * r[0]}
    limits = brute_limits(list(passing.values()))
    expected = {i for i, r in passing.items() if all(r[m] / r[0] <= limits[m] for m in limits)}
    got = {r["doc_id"] for r in quality.rate(docs_of(*texts)).collect() if r["kept"]}
    assert got == expected and 0 < len(got)


def test_limits_are_exact_quartiles_of_large_groups(spark, monkeypatch):
    """Far more values than a sketch holds, in all three levels; also when the sketch's bracket misses."""
    F = quality.F
    rows = spark.range(30_000).select(
        F.when(F.col("id") < 20_000, "a").when(F.col("id") < 29_900, "b").otherwise("c").alias("lang"),
        F.when(F.col("id").between(20_000, 29_899), F.concat(F.lit("s"), (F.col("id") % 99).cast("string"))).otherwise("s").alias("source"),
        F.lit(1000).cast("long").alias("n_words"), *[
            F.pmod(F.xxhash64("id", F.lit(k)), F.lit(100_003)).alias(c) for k, c in enumerate(quality.COUNTS[1:])],
        F.lit(False).alias("base_failed"))
    values = rows.collect()

    def exact(measure, take):
        mine = sorted(r[measure] / 1000 for r in values if take(r))
        low, high = (mine[-(-int(q * 4) * len(mine) // 4) - 1] for q in (0.25, 0.75))
        return high + 3 * (high - low)

    for margin in (quality.MARGIN, -0.01):
        monkeypatch.setattr(quality, "MARGIN", margin)
        got = {(r["__q_lang"], r["__q_source"]): r for r in quality.thresholds(rows).collect()}
        assert len(got) == 101
        for key, level, take in ((("a", "s"), "group", lambda r: r["lang"] == "a"), (("b", "s7"), "language", lambda r: r["lang"] == "b"),
                                 (("c", "s"), "table", lambda r: True)):
            assert got[key]["limit_level"] == level
            for rule, measure in (("symbols_per_word", "n_symbols"), ("word_length", "word_chars")):
                assert abs(got[key][f"__q_limit_{rule}"] - exact(measure, take)) < 1e-9
