import hashlib
import re

from clickloom.llm import private

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def brute(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text or ""):
            digits = re.sub(r"\D", "", m[0])
            good = {"email": True, "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
                    "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))}[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


TEXTS = [
    None, "", "nothing here", "a@b.c", "x a.b+c@d-e.co.uk, y", "a@b", "@b.c", "a@b.c@d.e", "a@b..c", "é😀 a@b.c",
    "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "001.002.003.0255", "1.2.3", "4111 1111 1111 1111", "4111111111111111",
    "4111-1111-1111-1112", "4111  1111 1111 1111", "+1 (017) 555-7713", "+123", "+1.2.3.4.5.6.7.8.9", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7",
    "5" * 6000, "1-" * 3000 + "1", "call +49 30 1234567 or mail me@here.org from 10.0.0.1", "\n4111111111111111\n",
    "7536784127813050 4111111111111111", "token 9f8e7d6c5b4a39281706f5e4d3c2b1a09f8e7d6c",
]


def test_base_spans_match_brute_force(docs_of):
    rows = private.find(docs_of(*TEXTS)).collect()
    for r in rows:
        want = brute(TEXTS[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), r["doc_id"]
        assert [r[f"n_{k}"] for k in private.KINDS] == [sum(w.startswith(k) for w in want) for k in private.KINDS]
        assert set(want) <= set(r["spans"].split(",") if r["spans"] else [])


def noise(i):
    return f"wort{i} und noch mehr text an dieser stelle "


def labelled(n):
    """Texts with base spans, decoys that fail their checks, and every tenth in a looser form."""
    out = []
    for i in range(n):
        good = ["4111111111111111", f"+1 ({200 + i % 700}) 555-{1000 + i}", f"10.{i % 255}.7.{i % 99}", f"u{i}@mail{i % 9}.example.com"][i % 4]
        out.append(noise(i) + good + " " + noise(i + 1) + (f" {4111111111111112 + 10 * i} " if i % 3 == 0 else ""))
    return out


def test_trees_add_what_the_rules_miss_and_leave_decoys(docs_of):
    hidden = noise(1) + "7536784127813050 4111111111111111 " + noise(2)
    texts = [*labelled(400), hidden, noise(7) * 5, noise(3) + "1234567812345678 " + noise(4)]
    rows = {r["doc_id"]: r for r in private.find(docs_of(*texts)).collect()}
    at = hidden.index("4111")
    assert f"card:{at}:{at + 16}" in rows[400]["spans"].split(",")
    assert rows[401]["spans"] == "" and rows[402]["spans"] == ""


def test_redaction(docs_of):
    df = docs_of((1, "ü mail a@b.c and 10.0.0.1!"), (1, "ü mail a@b.c and 10.0.0.1!"), (2, None), (3, "clean"))
    out = private.redact(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == [
        (1, "ü mail <email> and <ip>!"), (1, "ü mail <email> and <ip>!"), (2, None), (3, "clean")]
    assert private.redact(df.limit(0)).count() == 0


def test_no_python_on_the_main_path(docs_of):
    plan = private.find(docs_of("a@b.c"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_long_runs_take_linear_time(docs_of):
    """A megabyte of letters, of digits, of signs and of numbers: no start in a run scans it again."""
    import time

    texts = ["a" * 10**6 + " x@y.z", "ab1" * 350_000 + "@", "1" * 10**6 + " 1.2.3.4", "7 " * 500_000 + "x",
             "a.b" * 330_000 + " at home", "+1 " + " " * 10**6]
    begun = time.time()
    rows = {r["doc_id"]: r for r in private.find(docs_of(*texts)).collect()}
    assert rows[0]["n_email"] == 1 and rows[2]["n_ip"] == 1
    assert time.time() - begun < 60


def test_spans_do_not_depend_on_the_deal(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    one, two = (private.find(docs.repartition(n), keep_text=False).select("doc_id", "spans") for n in (2, 7))
    assert one.exceptAll(two).isEmpty()


def test_columns_named_like_helpers(docs_of):
    names = ["_row", "_base", "row", "c", "key", "features"]
    df = docs_of("mail a@b.c now", "call 030 1234567").withColumns({n: private.F.lit(n) for n in names})
    for r in private.find(df).collect():
        assert [r[n] for n in names] == names
    assert {r["row"] for r in private.redact(df).collect()} == {"row"}


def candidates_of(spark, n):
    """Card numbers found by the base rules, and as many plain numbers, each at a place of its own."""
    F = private.F
    good = F.col("id") % 2 == 0
    return spark.range(n).select(
        F.col("id").alias("key"), F.lit(0).alias("s"), F.lit(16).alias("e"),
        F.when(good, "4111111111111111").otherwise(F.concat(F.lit("411111111111"), F.lpad(F.col("id") % 7919, 4, "0"))).alias("v"),
        F.lit("x ").alias("before"), F.lit(" y").alias("after"), good.cast("double").alias("label"))


def test_every_candidate_teaches(spark):
    """No candidate is left out, however many there are; the looser form of each found one is there too."""
    n = 50_000
    told = private.examples(candidates_of(spark, n)).groupBy("label").agg(private.F.sum("n").alias("n"))
    assert {r["label"]: r["n"] for r in told.collect()} == {0.0: n // 2, 1.0: n}


def test_bins_as_classes_find_the_same(spark, monkeypatch):
    """Where Spark ML would draw rows to find cuts, bins are classes, over several parts."""
    few, least = private.train(candidates_of(spark, 4000))
    monkeypatch.setattr(private, "DRAWN", 0)
    monkeypatch.setattr(private, "PART", 5)
    monkeypatch.setattr(private, "N_BINS", 31)
    rows = private.examples(candidates_of(spark, 4000)).withColumn("copy", private.F.explode(private.F.sequence(
        private.F.lit(0), private.F.lit(40)))).withColumn("word_ip", private.F.col("word_ip") + private.F.col("copy") % 31)
    monkeypatch.setattr(private, "examples", lambda _: rows.drop("copy"))
    many, _ = private.train(candidates_of(spark, 10))
    test = private.assembled(private.binned(candidates_of(spark, 50)), False)
    for model in (few, many):
        right = model.transform(test).where("prediction = label").count()
        assert right >= 45


def test_trees_and_threshold_rest_on_all_candidates(spark, monkeypatch):
    """The trees in use learn from every candidate, and every candidate is scored for the threshold."""
    learnt, fit = [], private.GBTClassifier.fit
    monkeypatch.setattr(private.GBTClassifier, "fit", lambda self, rows: learnt.append(
        rows.agg(private.F.sum("n")).first()[0]) or fit(self, rows))
    table = candidates_of(spark, 4000)
    whole = private.examples(table).agg(private.F.sum("n")).first()[0]
    assert private.train(table) is not None
    assert learnt[2] == whole == learnt[0] + learnt[1]


def test_trees_are_the_same_beyond_the_rows_that_spark_ml_draws(spark, monkeypatch):
    """Bins stay numbers in their order: a cut lies between two of them, also for values that no candidate had."""
    few, least = private.train(candidates_of(spark, 4000))
    monkeypatch.setattr(private, "DRAWN", 0)
    many, same = private.train(candidates_of(spark, 4000))
    trees = [m.toDebugString.split("\n", 1)[1] for m in (few, many)]
    assert trees[0] == trees[1] and least == same


def test_cuts_are_found_in_all_rows(spark, monkeypatch):
    """Of 20 000 rows one in 2000 has the value that tells the classes apart: Spark ML keeps its cut."""
    F = private.F
    n = 20_000
    rare = F.col("id") % 2000 == 0
    rows = spark.range(n).select(
        *[F.lit(0.0).alias(c) for c in private.FEATURES if c not in ("n_chars", "n_digits")],
        F.when(rare, 9.0).otherwise(F.col("id") % 9).alias("n_chars"), (F.col("id") % 24).cast("double").alias("n_digits"),
        rare.cast("double").alias("label"), (F.floor(F.col("id") / 2000) % 2 == 0).alias("held"), F.lit(1).alias("n"))
    monkeypatch.setattr(private, "examples", lambda _: rows)
    model, _ = private.train(None)
    assert "feature 0 <= 8.5" in model.toDebugString
    assert private.most_bins(n) ** 2 >= n and private.most_bins(50) == 32
