"""Language identification: held-out accuracy, the sample, and odd input."""

import zlib

import pytest
from pyspark.sql import functions as F

from clickloom.llm import langid
from clickloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
WORDS = {"a": "tra lo mi fe ska pon du", "b": "grok unt wex zil hob ryn qua"}


def labelled(spark, n=60, lang=None):
    rows = []
    for i in range(n):
        name = "ab"[i % 2]
        words = WORDS[name].split()
        text = " ".join(words[(i * 7 + j * j) % 7] + words[(i + j) % 7] for j in range(40))
        rows.append((i, text, name if lang is None else lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_documents_get_their_language(spark):
    got = QUERIES["op12_language_id"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    both = got.join(docs, "doc_id")
    assert got.count() == docs.count()
    assert both.where("held_out <> (crc32(cast(cast(doc_id as string) as binary)) % 3 = 1)").isEmpty()
    rows = both.where("held_out and lang is not null and text rlike '\\\\p{L}'")
    right = rows.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    kept = rows.where(~F.col("rejected")).agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert right >= 0.97 and kept >= right
    assert both.where("not score between 0 and 1").isEmpty()


def test_only_what_compresses_best_counts(spark):
    known = labelled(spark).where("doc_id = 1").first()["text"][:60]
    model = langid.fit(labelled(spark))
    assert sorted(model) == ["a", "b"]
    odd = spark.createDataFrame(
        [(0, None), (1, ""), (2, "12 §$ ٣"), (3, "tralo mife skapon"), (4, known.upper() + "!"), (5, "tralo " * 200_000),
         (3, "tralo mife skapon")], "doc_id long, text string").withColumn("score", F.lit("mine"))
    got = sorted(map(tuple, langid.identify(odd, model).select("doc_id", "lang_pred", "lang", "score").collect()),
                 key=lambda r: r[0])
    assert [r[1] for r in got] == ["und", "und", "und", "a", "a", "b", "a"]
    assert [r[2] for r in got[:3]] == [None] * 3 and [r[3] for r in got[:3]] == [0.0] * 3
    assert all(0.5 < r[3] <= 1 for r in got[3:]) and got[3] == got[4]


def test_narrow_margins_are_rejected(spark):
    model = langid.fit(labelled(spark))
    docs = spark.createDataFrame([(0, "x"), (1, "tralomi feskapon dutra lomife")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    assert got[0]["lang"] is None and got[0]["lang_pred"] in ("a", "b") and got[0]["margin"] == 0
    assert got[1]["lang"] == "a"


def test_nothing_or_one_language_learnt(spark):
    docs = labelled(spark, 6)
    empty = langid.fit(docs.limit(0))
    assert empty == {} and {r["lang_pred"] for r in langid.identify(docs, empty).collect()} == {"und"}
    one = langid.fit(labelled(spark, 6, "only"))
    assert {(r["lang_pred"], r["score"]) for r in langid.identify(docs, one).collect()} == {("only", 1.0)}
    assert langid.identify(docs.limit(0), one).collect() == []
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert langid.fit(unlabelled) == {}


def test_copies_do_not_fill_a_dictionary(spark, monkeypatch):
    monkeypatch.setattr(langid, "PIECES", 5)
    docs = labelled(spark).unionByName(spark.createDataFrame(
        [(1000 + i, "copy of one text", "a") for i in range(300)], "doc_id long, text string, lang string"))
    sample = langid.sample(docs).where("lang = 'a'").collect()
    assert len(sample) == 5 == len({r["piece"] for r in sample})
    monkeypatch.setattr(langid, "MODEL_BYTES", langid.DICTIONARY)
    with pytest.raises(ValueError, match="languages"):
        langid.fit(docs)


def test_long_texts_count_whole(spark):
    model = langid.fit(labelled(spark))
    classifier = langid.Classifier(model)
    a, b = "tralo mife skapon " * 2000, "grokunt wexzil hobryn " * 4000
    assert classifier.of(a + b)[0] == "b" and classifier.of(a * 4 + b)[0] == "a"
    assert zlib.crc32(b"7") % 3 == [r[0] for r in spark.range(1).select(F.crc32(F.lit("7").cast("binary")) % 3).collect()][0]
