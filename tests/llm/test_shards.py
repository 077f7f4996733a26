from collections import Counter

import pytest
from pyspark.sql import functions as F

from clickloom.llm import shards
from clickloom.llm.queries import QUERIES


def test_slots_are_dealt_evenly_and_move_little():
    names = [f"n{i}" for i in range(10)]
    table = shards.fill(names, 1009)
    sizes = Counter(table)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    without = shards.fill(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, without) if a != "n9")
    assert moved < 1009 * 0.1
    assert table == shards.fill(reversed(names), 1009)  # the order of the list does not matter


def test_the_turns_by_hand():
    """Each shard's slot is the first free one of its order, turn by turn."""
    names, slots = ["a", "b", "c"], 7
    number = lambda t: int(shards.hashlib.md5(t.encode()).hexdigest()[:8], 16) % 2**31
    orders = {n: [(number("offset:" + n) + c * (number("skip:" + n) % 6 + 1)) % slots for c in range(slots)] for n in names}
    owner = {}
    for turn in range(slots):
        n = names[turn % 3]
        owner[next(s for s in orders[n] if s not in owner)] = n
    assert shards.fill(names, slots) == [owner[s] for s in range(slots)]


def test_parameters_are_checked():
    for names, slots in (([], 7), (["a"], 8), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            shards.fill(names, slots)


def test_rows_are_placed_without_a_shuffle(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "id long, shard string")
    placed = shards.place(df, shards.lookup_table(spark), "id")
    assert "Exchange hashpartitioning" not in placed._jdf.queryExecution().executedPlan().toString()
    rows = placed.collect()
    assert len(rows) == 3 and len({r["shard"] for r in rows if r["id"] == 1}) == 1
    assert placed.columns == ["id", "slot", "shard"]
    assert shards.place(df.limit(0), shards.lookup_table(spark), "id").count() == 0


def test_a_hot_shard_is_written_in_several_files(spark, tmp_path):
    df = spark.range(1000).select(F.lit(1).alias("k"), "id")
    placed = shards.place(df, shards.lookup_table(spark, ["a", "b"], 7), "k")
    shards.write_shards(placed, str(tmp_path / "s"), spread=4, max_rows=100)
    files = [f for d in (tmp_path / "s").iterdir() if d.is_dir() for f in d.iterdir() if f.suffix == ".parquet"]
    assert len(files) >= 10
    assert spark.read.parquet(str(tmp_path / "s")).count() == 1000


def test_counted_shards_have_writers_by_their_rows(spark, tmp_path):
    """A shard of equal rows is written by several tasks, and all of them stay."""
    path = str(tmp_path / "s")
    df = spark.range(3000).select(F.when(F.col("id") < 2900, 1).otherwise(F.col("id")).alias("k"), F.lit("é").alias("v"))
    placed = shards.place(df.repartition(16), shards.lookup_table(spark, ["7", "8"], 7), "k")
    shards.write_shards(placed, path, max_rows=500)
    files = {d.name: [f for f in d.iterdir() if f.suffix == ".parquet"] for d in (tmp_path / "s").iterdir() if d.is_dir()}
    assert set(files) == {"shard=7", "shard=8"}
    tasks = {f.name.split("-c0")[0] for f in max(files.values(), key=len)}
    assert len(tasks) > 1
    back = shards.read_shards(spark, path, placed.schema)
    assert back.dtypes == placed.dtypes  # names like numbers stay text
    assert Counter(map(tuple, back.collect())) == Counter(map(tuple, placed.collect()))


def test_empty_tables_and_missing_keys_are_written(spark, tmp_path):
    df = spark.createDataFrame([(None, "x", "y"), (None, "x", "y"), (3, None, None)], "id long, shard string, v string")
    table = shards.lookup_table(spark)
    for name, rows in (("none", df.limit(0)), ("some", df)):
        placed = shards.place(rows, table, "id")
        shards.write_shards(placed, str(tmp_path / name))
        back = shards.read_shards(spark, str(tmp_path / name), placed.schema)
        assert back.columns == ["id", "v", "slot", "shard"]
        assert sorted(map(str, back.collect())) == sorted(map(str, placed.collect()))


def test_the_query_puts_every_document_on_its_shard(spark):
    sf = "/root/testdata/sf0.001"
    table = shards.fill(shards.SHARDS)
    got = {r["doc_id"]: (r["slot"], r["shard"]) for r in QUERIES["op9_sharding"](spark, sf).collect()}
    ids = [r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()]
    slot = {i: int(shards.hashlib.md5(f"key:{i}".encode()).hexdigest()[:8], 16) % 2**31 % shards.SLOTS for i in ids}
    assert got == {i: (slot[i], table[slot[i]]) for i in ids}
