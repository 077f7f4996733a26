"""The driver's tables in the shape of the library's inputs, for Spark and for the SQL check."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.values import wall_clock
from clickloom.sources.tables import read_parquet

AS_OF = datetime(2024, 1, 24)


SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
              "props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet", SCHEMAS[name])


def _offer_key():
    return F.get_json_object("props", "$.k").cast("bigint")


def impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id1"),
        F.col("user_id").alias("id2"),
        _offer_key().alias("id3"),
        F.col("ts").alias("id4"),
        F.col("ts").cast("date").alias("id5"),
        F.col("value").alias("f1"),
        (F.col("event_type") == "click").cast("int").alias("y"),
    )


def train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impressions(spark, sf_dir).where(F.col("id5") < wall_clock(AS_OF.date()))


def test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impressions(spark, sf_dir).where(F.col("id5") >= wall_clock(AS_OF.date())).drop("y")


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers without one type: in joins, some impressions must have no offer."""
    return offers_all(spark, sf_dir).where(F.col("id10") != "PROMO")


def offers_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    def days_after(day: str):
        return F.lit(day).cast("timestamp_ntz") + F.make_dt_interval(F.col("p_size"))

    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("id3"),
        F.col("p_brand").alias("id9"),
        F.col("p_type").alias("id10"),
        F.col("p_name").alias("id11"),
        days_after("2024-01-01 00:00:00").alias("id12"),
        F.when(F.col("p_type") != "LARGE", days_after("2024-01-15 00:00:00")).alias("id13"),
        F.when(F.col("p_type") != "ECONOMY", ((F.col("p_size") - 1) * 1.5).cast("double")).alias("f376"),
    )


def trans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of one status: in joins, some customers must have no transaction."""
    return _trans(table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F"))


def trans_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trans(table(spark, sf_dir, "orders"))


def _trans(orders: DataFrame) -> DataFrame:
    amount = F.when(F.col("o_orderpriority") == "5-LOW", "n/a").otherwise(
        F.col("o_totalprice").cast("string")
    )
    return orders.select(
        F.col("o_custkey").alias("id2"), amount.alias("f367"), F.col("o_orderdate").alias("f370")
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    past = table(spark, sf_dir, "events").where(
        F.col("event_type").isin("view", "click") & (F.col("ts") < wall_clock(AS_OF))
    )
    return past.select(F.col("user_id").alias("id2"), _offer_key().alias("id3"))


def dated_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as text in two formats, with junk and missing ones between."""
    priority = F.col("o_orderpriority")
    text = (
        F.when(priority == "1-URGENT", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .when(priority == "2-HIGH", F.date_format("o_orderdate", "MM/dd/yyyy"))
        .when(priority == "5-LOW", "soon")
    )
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id1"), text.alias("id4"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Impressions with two stand-in scores, functions of ``f1`` between 0 and 1."""
    return impressions(spark, sf_dir).select(
        "id1", "id2", "id3", "id5", "y",
        (F.col("f1") / (F.col("f1") + 10.0)).alias("first_score"),
        (F.col("f1") / (F.col("f1") + 50.0)).alias("second_score"),
    )


# The same views in SQL, as common table expressions.
SQL_VIEWS = {
    "impressions": """
        select event_id as id1, user_id as id2,
               cast(json_extract_string(props, '$.k') as bigint) as id3,
               ts as id4, cast(ts as date) as id5, value as f1,
               cast(case when event_type = 'click' then 1 else 0 end as integer) as y
        from events""",
    "train": "select * from impressions where id5 < date '2024-01-24'",
    "test": "select * exclude (y) from impressions where id5 >= date '2024-01-24'",
    "offers": "select * from offers_all where id10 <> 'PROMO'",
    "offers_all": """
        select p_partkey as id3, p_brand as id9, p_type as id10, p_name as id11,
               cast(timestamp '2024-01-01 00:00:00' + to_days(cast(p_size as integer)) as timestamp)
                   as id12,
               case when p_type = 'LARGE' then null
                    else cast(timestamp '2024-01-15 00:00:00' + to_days(cast(p_size as integer))
                              as timestamp) end as id13,
               case when p_type = 'ECONOMY' then null
                    else cast((p_size - 1) * 1.5 as double) end as f376
        from part""",
    "trans": """
        select o_custkey as id2,
               case when o_orderpriority = '5-LOW' then 'n/a'
                    else cast(o_totalprice as varchar) end as f367,
               o_orderdate as f370
        from orders where o_orderstatus = 'F'""",
    "trans_all": """
        select o_custkey as id2,
               case when o_orderpriority = '5-LOW' then 'n/a'
                    else cast(o_totalprice as varchar) end as f367,
               o_orderdate as f370
        from orders""",
    "history": """
        select user_id as id2, cast(json_extract_string(props, '$.k') as bigint) as id3
        from events where event_type in ('view', 'click') and ts < timestamp '2024-01-24 00:00:00'""",
    "dated_text": """
        select o_orderkey as id1,
               case o_orderpriority
                   when '1-URGENT' then strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
                   when '2-HIGH' then strftime(o_orderdate, '%m/%d/%Y')
                   when '5-LOW' then 'soon' end as id4
        from orders""",
    "scored": """
        select id1, id2, id3, id5, y, f1 / (f1 + cast(10 as double)) as first_score,
               f1 / (f1 + cast(50 as double)) as second_score
        from impressions""",
    # derived views shared by several checks
    "meta": """
        select id3,
               cast(case when (id12 is null or id12 <= timestamp '2024-01-24 00:00:00')
                          and (id13 is null or id13 >= timestamp '2024-01-24 00:00:00')
                         then 1 else 0 end as integer) as is_currently_active,
               case when f376 is null then 'unk' when f376 = 0 then 'zero' when f376 < 5 then '<5'
                    when f376 < 20 then '5-20' when f376 < 50 then '20-50' else '50+' end
                   as discount_bucket,
               id9, f376, id10, id11
        from offers""",
    "meta_all": """
        select id3,
               cast(case when (id12 is null or id12 <= timestamp '2024-01-24 00:00:00')
                          and (id13 is null or id13 >= timestamp '2024-01-24 00:00:00')
                         then 1 else 0 end as integer) as is_currently_active,
               case when f376 is null then 'unk' when f376 = 0 then 'zero' when f376 < 5 then '<5'
                    when f376 < 20 then '5-20' when f376 < 50 then '20-50' else '50+' end
                   as discount_bucket,
               id9, f376, id10, id11
        from offers_all""",
    "counts": "select id2, id3, count(*) as past_impression_count from history group by id2, id3",
    "rfm": """
        select id2,
               cast(floor((epoch_us(timestamp '2024-01-24 00:00:00') - epoch_us(max(f370)))
                          / 86400000000.0) as bigint) as recency,
               count(id2) as frequency,
               coalesce(sum(try_cast(f367 as double)), cast(0 as double)) as monetary
        from trans group by id2""",
    "spending": """
        select id2, count(*) as trans_cnt,
               sum(coalesce(try_cast(f367 as double), 0)) as trans_amt_sum,
               avg(coalesce(try_cast(f367 as double), 0)) as trans_amt_mean
        from trans group by id2""",
    "offer_rates": "select id3, avg(cast(y as double)) as ctr_offer from train group by id3",
    "user_rates": "select id2, avg(cast(y as double)) as ctr_user from train group by id2",
}

# Which views each view is built from.
SQL_NEEDS = {
    "train": ["impressions"], "test": ["impressions"], "scored": ["impressions"],
    "offers": ["offers_all"], "meta": ["offers_all", "offers"], "meta_all": ["offers_all"], "counts": ["history"], "rfm": ["trans"], "spending": ["trans"],
    "offer_rates": ["impressions", "train"], "user_rates": ["impressions", "train"],
}


def with_views(names: list[str], query: str) -> str:
    """``query`` under the common table expressions it needs."""
    wanted: list[str] = []
    for name in names:
        for view in [*SQL_NEEDS.get(name, []), name]:
            if view not in wanted:
                wanted.append(view)
    ctes = ",\n".join(f"{v} as ({SQL_VIEWS[v].strip()})" for v in wanted)
    return f"with {ctes}\n{query.strip()}"
