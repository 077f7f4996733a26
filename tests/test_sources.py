"""Reading, writing and keeping models."""

from datetime import date, datetime

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators.numeric_rule import NumericRule
from clickloom.plans.models import assembler
from clickloom.session import discard, shared_folder, written
from clickloom.sources import schemas, tables
from clickloom.sources.bundle import Bundle, drop_old_versions, load_bundle, save_bundle


def put(path, text):
    path.write_bytes(text.encode())
    return str(path)


def test_csv_with_schema(spark, tmp_path):
    path = put(tmp_path / "a.csv", 'id3,id2,id4,f1,f42\n7,1,2023-11-05 01:02:03,NA,"a, b"\n8,NaN,,1e3,null\n')
    schema = T.StructType.fromDDL("id2 bigint, id3 bigint, id4 timestamp_ntz, f1 double, f42 string, f9 int")
    df = tables.read_csv(spark, path, schema)
    assert df.columns == ["id2", "id3", "id4", "f1", "f42"]  # by name, absent ones left out
    assert df.collect() == [
        (1, 7, datetime(2023, 11, 5, 1, 2, 3), None, "a, b"), (None, 8, None, 1000.0, None)]


def test_csv_bad_values(spark, tmp_path):
    path = put(tmp_path / "a.csv", "id2,f1,id5\nx,1d,2023-11-05\n2,2,11/05/2023\n")
    schema = T.StructType.fromDDL("id2 bigint, f1 double, id5 date")
    got = tables.read_csv(spark, path, schema, lenient=True).collect()
    assert got == [(None, None, date(2023, 11, 5)), (2, 2.0, None)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tables.read_csv(spark, path, schema).collect()


def test_csv_types_learnt(spark, tmp_path):
    path = put(tmp_path / "a.csv", "i,d,s,b,n,m\n1,1.5,x,True,NA,1\n2,7,1,False,,NA\n")
    df = tables.read_csv(spark, path)
    assert dict(df.dtypes) == {"i": "bigint", "d": "double", "s": "string", "b": "boolean",
                               "n": "double", "m": "bigint"}
    assert df.collect()[1] == (2, 7.0, "1", False, None, None)


def test_csv_round_trip(spark, tmp_path):
    rows = [("a,b", 1, 0.5, date(2023, 11, 5)), ('say "x"', None, None, None)]
    df = spark.createDataFrame(rows, "s string, i bigint, d double, t date").coalesce(1)
    tables.write_csv(df, str(tmp_path / "out"))
    head = next((tmp_path / "out").glob("*.csv")).read_text().splitlines()[0]
    assert head == "s,i,d,t"
    assert tables.read_csv(spark, str(tmp_path / "out"), df.schema).collect() == rows
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        tables.write_csv(df, str(tmp_path / "out"))
    tables.write_csv(df, str(tmp_path / "out"), mode="overwrite")


def test_parquet_reads_declared_columns_only(spark, tmp_path):
    df = spark.range(4).select("id", (F.col("id") % 2).alias("day"), F.lit("x").alias("s"))
    path = str(tmp_path / "t")
    tables.write_parquet(df, path, partition_by=["day"])
    got = tables.read_parquet(spark, path, "id bigint, day bigint").where("day = 1 and id > 1")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,1)]" in plan
    assert "ReadSchema: struct<id:bigint>" in plan and "PartitionFilters: [isnotnull(day" in plan
    assert [r["id"] for r in got.collect()] == [3]


def test_dictionary(spark, tmp_path):
    path = put(tmp_path / "d.csv", 'masked_column,Description,Type\r\nid1,Key (masked),Key\r\n'
                                   'f35,"Clicks in \'A\',\'B\', all",Numerical\r\nf99, other,Numerical\r\n')
    d = tables.read_dictionary(spark, path)
    assert d.count() == 3 and d.where("masked_column = 'f35'").first()[1] == "Clicks in 'A','B', all"
    df = tables.with_comments(spark.createDataFrame([("a", 1.0)], "id1 string, f35 double"), d)
    assert df.schema["f35"].metadata == {"comment": "Clicks in 'A','B', all"}
    assert df.schema["id1"].metadata == {"comment": "Key (masked)"}


def test_schemas():
    s = schemas.impressions()
    assert len(s) == 6 + 365 and "f218" not in s.names
    assert s["f42"].dataType == T.StringType() and s["f300"].dataType == T.IntegerType()
    assert "y" not in schemas.impressions(label=None).names


def test_written_table_ends_the_lineage(spark):
    df = spark.range(5).withColumn("r", F.monotonically_increasing_id())
    kept = written(df, "x")
    assert kept.schema == df.schema or kept.dtypes == df.dtypes
    assert "Range" not in kept._jdf.queryExecution().optimizedPlan().toString()
    assert shared_folder(spark) in kept.inputFiles()[0]


def test_csv_line_breaks_in_quotes(spark, tmp_path):
    path = put(tmp_path / "a.csv", 's,i\n"a\nb",1\nc,2\n')
    assert tables.read_csv(spark, path, multi_line=True).collect() == [("a\nb", 1), ("c", 2)]


class Session:
    """Only what the choice of the folder looks at."""

    def __init__(self, folder, master, warehouse="file:/here/warehouse"):
        self.conf, self.sparkContext, self.master, self.warehouse = self, self, master, warehouse
        self.folder = folder

    def get(self, key, default=None):
        return {"spark.checkpoint.dir": self.folder, "spark.sql.warehouse.dir": self.warehouse}[key]

    def getCheckpointDir(self):
        return None


def test_shared_folder_is_the_clusters():
    assert shared_folder(Session("s3a://bucket/x/", "yarn")) == "s3a://bucket/x"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session(None, "yarn"))
    assert shared_folder(Session(None, "local[2]")) == "file:/here/warehouse/_scratch"
    assert shared_folder(Session(None, "yarn", "hdfs://h/w")) == "hdfs://h/w/_scratch"


def test_discarded_table_is_gone(spark):
    kept = written(spark.range(5), "x")
    discard(kept)
    with pytest.raises(Exception, match="(?i)not exist|FILE_NOT_FOUND|No such file"):
        kept.count()


def test_nan_is_missing_on_entry(spark, tmp_path):
    spark.createDataFrame([(1.0,), (float("nan"),)], "f double").write.parquet(str(tmp_path / "n"))
    got = tables.read_parquet(spark, str(tmp_path / "n"))
    assert sorted(str(r["f"]) for r in got.collect()) == ["1.0", "None"]


def test_csv_keeps_microseconds(spark, tmp_path):
    df = spark.sql("select timestamp_ntz '2024-01-02 03:04:05.123456' as t, timestamp_ntz '2024-01-02 00:00:00' as u")
    tables.write_csv(df, str(tmp_path / "c"))
    assert tables.read_csv(spark, str(tmp_path / "c"), schema=df.schema).collect() == df.collect()


def test_bundle_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("b", "1", 1.0), ("a", "2", 2.0), (None, None, 3.0)],
                               "s string, n string, f double")
    rule = NumericRule().fit(df)
    bundle = Bundle(PipelineModel([assembler(["f"])]), ["f"], "y", rule, {"as_of": "2024-01-24"})
    path = str(tmp_path / "bundle")
    save_bundle(bundle, path)
    save_bundle(bundle, path)  # replaces the older one
    save_bundle(load_bundle(spark, path), path)  # onto itself
    class Broken:
        def write(self):
            raise OSError("disk")

    with pytest.raises(OSError):
        save_bundle(Bundle(Broken(), ["g"], "y"), path)  # the older one stays
    drop_old_versions(spark, path)
    got = load_bundle(spark, path)
    assert (got.features, got.target, got.config) == (["f"], "y", {"as_of": "2024-01-24"})
    assert sorted(got.rule.transform(df).collect()) == sorted(rule.transform(df).collect())
    assert got.model.stages[0].getInputCols() == ["f"]


def test_missing_bundle_is_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no fitted model"):
        load_bundle(spark, str(tmp_path / "nothing"))
