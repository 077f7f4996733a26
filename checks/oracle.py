"""The same results in SQL over the driver's tables."""

from __future__ import annotations

from .views import with_views

FIRST = "first_score"
BLEND = "(0.7::double * first_score + 0.3::double * second_score)"
EPS = "2.220446049250313e-16::double"


def _loss(score: str) -> str:
    p = f"least(greatest({score}, {EPS}), 1 - {EPS})"
    return f"round(avg(case when y = 1 then -ln({p}) else -ln(1 - {p}) end), 6)"


def _classes(name: str, source: str, value: str) -> str:
    """A table expression numbering the distinct values of a column in text order."""
    return f"""{name} as (
        select v, row_number() over (order by v) - 1 as code
        from (select distinct {value} as v from {source}) where v is not null)"""


SPENDING = """
    coalesce(trans_cnt, 0) as trans_cnt,
    round(coalesce(trans_amt_sum, 0), 2) as trans_amt_sum,
    round(coalesce(trans_amt_mean, 0), 4) as trans_amt_mean"""

PARTS = """
    cast(hour(id4) as integer) as id4_hour, cast(day(id4) as integer) as id4_day,
    cast(month(id4) as integer) as id4_month,
    cast(isodow(id4) - 1 as integer) as id4_dayofweek,
    cast(case when isodow(id4) >= 6 then 1 else 0 end as integer) as id4_is_weekend"""


def _shares(source: str, column: str) -> str:
    number = f"try_cast({column} as double)"
    return f"""select '{column}' as "column", count(*) as rows, count({column}) as "values",
        count({number}) as numbers, round(count({number}) / count(*)::double, 6) as share,
        count({number}) / count(*)::double > 0.5 as is_numeric from {source}"""


def _zeros(column: str, value: str) -> str:
    return f"""select count(*) as rows, '{column}' as "column", count({value}) as "values",
        count({value}) = 0 as all_null, bool_and({value} = 0) as all_zero from impressions"""


def _variance(name: str, value: str) -> str:
    return f"""select '{name}' as feature, round(var_pop({value}), 6) as variance,
        var_pop({value}) > 1e-5 as kept from joined"""


JOINED = "joined as (select t.*, m.* exclude (id3) from train t left join meta m on t.id3 = m.id3)"
JOINED_ALL = JOINED.replace("from train t", "from impressions t")
LAST = """last as (
    select id2, id3, pred from (
        select id2, id3, first_score as pred,
               row_number() over (partition by id2, id3 order by id1 desc) as r
        from scored where id5 < date '2024-01-24') where r = 1),
    matched as (
        select t.id1, t.id2, t.id3,
               case when l.id2 is not null then l.pred else cast(0 as double) end as pred,
               l.id2 is not null as matched
        from test t left join last l on t.id2 = l.id2 and t.id3 = l.id3)"""


# One boosted tree of three leaves on features a, b, c, from rows with gradient g and curvature h.
TREE = """
    cells as (select *, unnest(['a', 'b', 'c']) as f, unnest([a, b, c]) as v from graded),
    sums1 as (
        select f, v, sum(sum(g)) over w as lg, sum(sum(h)) over w as lh, sum(count(*)) over w as ln,
               sum(sum(g)) over p as wg, sum(sum(h)) over p as wh, sum(count(*)) over p as wn
        from cells group by f, v window w as (partition by f order by v), p as (partition by f)),
    split1 as (
        select f, v, GAIN as gain from sums1 where ALLOWED order by gain desc, f, v limit 1),
    sided as (
        select r.*, case when (case s.f when 'a' then a when 'b' then b else c end) <= s.v then 0 else 1 end as side
        from graded r, split1 s),
    cells2 as (select *, unnest(['a', 'b', 'c']) as f, unnest([a, b, c]) as v from sided),
    sums2 as (
        select side, f, v, sum(sum(g)) over w as lg, sum(sum(h)) over w as lh, sum(count(*)) over w as ln,
               sum(sum(g)) over p as wg, sum(sum(h)) over p as wh, sum(count(*)) over p as wn
        from cells2 group by side, f, v
        window w as (partition by side, f order by v), p as (partition by side, f)),
    split2 as (
        select side, f, v, GAIN as gain from sums2 where ALLOWED order by gain desc, side, f, v limit 1),
    leaves as (
        select r.*, case when r.side <> s.side then 2
            when (case s.f when 'a' then a when 'b' then b else c end) <= s.v then 0 else 1 end as leaf
        from sided r, split2 s),
    weights as (select leaf, -sum(g) / (sum(h) + 1) as weight from leaves group by leaf)""".replace(
    "GAIN", "lg * lg / (lh + 1) + (wg - lg) * (wg - lg) / (wh - lh + 1) - wg * wg / (wh + 1)").replace(
    "ALLOWED", "ln >= 20 and wn - ln >= 20 and lh >= 1e-3 and wh - lh >= 1e-3")
FEATURES_ABC = "id1, id2, y, id2 % 11 as a, id3 % 13 as b, hour(id4) as c"
LOGISTIC = f"""graded as (
        select {FEATURES_ABC}, m.p - y as g, m.p * (1 - m.p) as h, ln(m.p / (1 - m.p)) as base
        from impressions, (select avg(y) as p from impressions) m),{TREE}"""
# at equal scores a click's gradient is minus the share of the others, and the other way round
LISTWISE = f"""lists as (
        select id2 as customer, sum(y) as clicks, count(*) - sum(y) as others from impressions group by id2),
    shares as (
        select {FEATURES_ABC}, case when y = 1 then others else clicks end / (1 + clicks * others)::double as share
        from impressions join lists on id2 = customer),
    graded as (
        select *, case when y = 1 then -share else share end as g, share * (1 - share) as h, 0 as base from shares),{TREE}"""


def _build() -> dict[str, str]:
    q: dict[str, str] = {}

    def add(name: str, views: list[str], query: str, extra: str | None = None) -> None:
        if extra:
            text = with_views(views, "\0")
            q[name] = text.replace("\n\0", f",\n{extra}\n{query.strip()}")
        else:
            q[name] = with_views(views, query) if views else query.strip()

    add("scan_parquet", [], "select * from events")
    add("scan_tables", [], " union all ".join(
        f"select '{t}' as \"table\", count(*) as rows, count({second}) as second_values, "
        f"cast(min({key}) as bigint) as low, cast(max({key}) as bigint) as high from {t}"
        for t, key, second in (("events", "event_id", "ts"), ("orders", "o_orderkey", "o_custkey"),
                               ("part", "p_partkey", "p_name"), ("customer", "c_custkey", "c_name"),
                               ("lineitem", "l_orderkey", "l_partkey"))))
    add("missing_meta_defaults", ["impressions"], """
        select * replace (cast(id5 as varchar) as id5), cast(1 as integer) as is_currently_active, 'unk' as discount_bucket,
               cast(0 as integer) as trans_cnt, cast(0 as double) as trans_amt_sum,
               cast(0 as double) as trans_amt_mean from impressions""")
    add("normalize_keys", ["impressions"],
        "select id1, cast(id2 as varchar) as id2, cast(id3 as bigint) as id3 from impressions")
    add("coerce_numeric", ["trans_all"],
        "select id2, f367, coalesce(try_cast(f367 as double), 0) as amount from trans_all")
    add("parse_timestamp", ["dated_text"], """
        select id1, id4, cast(try_strptime(id4, ['%Y-%m-%d %H:%M:%S', '%m/%d/%Y']) as timestamp)
            as parsed from dated_text""")
    add("calendar_features", ["impressions"], f"select id1, {PARTS} from impressions")
    add("offer_active_flag", ["offers_all", "meta_all"], """
        select o.id3, o.id12, o.id13, m.is_currently_active
        from offers_all o join meta_all m on o.id3 = m.id3""")
    add("discount_bucket", ["meta_all"], "select id3, f376, discount_bucket from meta_all")
    add("offer_meta_prep", ["meta_all"], "select * from meta_all")
    add("feature_projection", ["impressions", "meta"],
        "select f1, coalesce(is_currently_active, 0) as is_currently_active, "
        "coalesce(f376, 0) as f376 from joined", JOINED_ALL)
    add("align_features", ["impressions"], """
        select id1, cast(0 as double) as past_impression_count, f1, cast(0 as double) as f2
        from impressions""")
    add("fill_nulls", ["offers_all"], """
        select id3, id10, coalesce(f376, -1) as f376, id13, coalesce(f376, 0) as all_filled, id11
        from offers_all""")
    add("infer_numeric_columns", ["trans_all", "offers_all", "dated_text"], " union all ".join([
        _shares("trans_all", "f367"), *[_shares("offers_all", c) for c in ("id9", "id10", "id11")],
        _shares("dated_text", "id4"),
    ]))
    add("column_all_zero", ["impressions"], " union all ".join([
        _zeros("id1", "id1"), _zeros("f1", "f1"), _zeros("y", "y"), _zeros("trans_cnt", "0"),
    ]))
    add("join_offer_meta", ["impressions", "meta"], """
        select i.* replace (cast(i.id5 as varchar) as id5), m.* exclude (id3, is_currently_active),
               coalesce(m.is_currently_active, 0) as is_currently_active
        from impressions i left join meta m on i.id3 = m.id3""")
    add("past_impressions", ["impressions", "counts"], """
        select i.id1, i.id2, i.id3, coalesce(c.past_impression_count, 0) as past_impression_count
        from impressions i left join counts c on i.id2 = c.id2 and i.id3 = c.id3""")
    add("rfm_features", ["impressions", "rfm"], """
        select i.id1, i.id2, coalesce(recency, 0) as recency, coalesce(frequency, 0) as frequency,
               round(coalesce(monetary, 0), 2) as monetary
        from impressions i left join rfm r on i.id2 = r.id2""")
    add("trans_features", ["impressions", "spending"], f"""
        select i.id1, i.id2, {SPENDING} from impressions i left join spending s on i.id2 = s.id2""")
    add("ctr_by_offer", ["offer_rates"],
        "select id3, round(ctr_offer, 9) as ctr_offer from offer_rates")
    add("ctr_by_user", ["user_rates"], "select id2, round(ctr_user, 9) as ctr_user from user_rates")
    add("ctr_encoding", ["offer_rates", "user_rates"], """
        select i.id1, round(ctr_offer, 9) as ctr_offer, round(ctr_user, 9) as ctr_user
        from impressions i left join offer_rates o on i.id3 = o.id3
        left join user_rates u on i.id2 = u.id2""")
    add("group_sizes", ["impressions"], "select id2, count(*) as group_size from impressions group by id2")
    add("variance_filter", ["impressions", "meta"], " union all ".join([
        _variance("f1", "f1"), _variance("y", "y"),
        _variance("is_currently_active", "is_currently_active"), _variance("f376", "f376"),
        _variance("constant", "1"),
    ]), JOINED_ALL)
    add("target_distribution", ["impressions"], "select y, count(*) as n from impressions group by y")
    names = ("discount_bucket", "id9", "id10", "id11")
    add("label_encode", ["train", "meta"],
        "select j.id1, " + ", ".join(f"coalesce(c_{n}.code, -1) as {n}" for n in names)
        + " from joined j " + " ".join(f"left join c_{n} on j.{n} = c_{n}.v" for n in names),
        ",\n".join([JOINED, *[_classes(f"c_{n}", "joined", n) for n in names]]))
    pool = """pool as (select i.id1, coalesce(m.id9, 'nan') as id9, coalesce(m.id10, 'nan') as id10
        from impressions i left join meta m on i.id3 = m.id3)"""
    add("joint_label_encode", ["impressions", "meta"], """
        select p.id1, a.code as id9, b.code as id10 from pool p
        join c_id9 a on p.id9 = a.v join c_id10 b on p.id10 = b.v""",
        ",\n".join([pool, _classes("c_id9", "pool", "id9"), _classes("c_id10", "pool", "id10")]))
    texts = """texts as (
        select i.id1, i.id5, i.id2::varchar || '_' || i.id3::varchar as pair,
               coalesce(m.id11, 'missing') as id11
        from impressions i left join meta m on i.id3 = m.id3),
        seen as (select * from texts where id5 < date '2024-01-24')"""
    add("encode_unseen", ["impressions", "meta"], """
        select t.id1, coalesce(a.code, 0) as pair, coalesce(b.code, 0) as id11
        from texts t left join c_pair a on t.pair = a.v left join c_id11 b on t.id11 = b.v
        where t.id5 >= date '2024-01-24'""",
        ",\n".join([texts, _classes("c_pair", "seen", "pair"), _classes("c_id11", "seen", "id11")]))
    add("group_fold", ["impressions"], """
        select id1, id2, cast(cast('0x' || substr(md5(cast(id2 as varchar)), 1, 8) as bigint) % 5
            as integer) as fold from impressions""")
    add("temporal_split", ["impressions"], """
        select id1, case when id5 < date '2024-01-24' then 'train' else 'valid' end as part
        from impressions""")
    add("random_split", ["impressions"], f"""
        select id1, case when cast('0x' || substr(md5(cast(id1 as varchar) || ':42'), 1, 8)
            as bigint) < {int(0.2 * (1 << 32))} then 'valid' else 'train' end as part
        from impressions""")
    add("split_summary", ["impressions"], """
        select case when id5 < date '2024-01-24' then 'train' else 'valid' end as part,
               count(*) as n, round(avg(cast(y as double)), 9) as target_rate
        from impressions group by 1""")
    add("blend_scores", ["scored"], f"select id1, round({BLEND}, 9) as pred from scored")
    add("hard_labels", ["scored"],
        "select id1, cast(first_score > 0.5 as integer) as pred from scored")
    add("log_loss", ["scored"], f"""
        select {_loss(FIRST)} as first_loss, {_loss('second_score')} as second_loss,
               {_loss(BLEND)} as blend_loss from scored""")
    add("prediction_range", ["scored"], """
        select count(*) as n, min(first_score) as min_pred, max(first_score) as max_pred
        from scored""")
    add("rank_score", ["scored"], """
        select id1, id2, round((first_score - min(first_score) over (partition by id2))
            / (max(first_score) over (partition by id2) - min(first_score) over (partition by id2)
               + 1e-9::double), 6) as rank_score from scored""")
    add("dedupe_last", ["scored"], """
        select id2, id3, id1, first_score from (
            select *, row_number() over (partition by id2, id3 order by id1 desc) as r from scored)
        where r = 1""")
    add("template_match", ["test", "scored"], "select * from matched", LAST)
    add("match_summary", ["test", "scored"], """
        select count(*) as n, cast(sum(cast(matched as bigint)) as bigint) as n_matched
        from matched""", LAST)
    rebuilt = "id2::varchar || '_' || id3::varchar || '_16-23_2023-11-05'"
    add("submission_ids", ["scored"], f"""
        select case when id1::varchar in ('0.0', '0') then {rebuilt} else id1::varchar end as id1,
               id2, id3, strftime(id5, '%m/%d/%Y') as id5, first_score as pred, 'kept' as source
        from scored
        union all
        select {rebuilt}, id2, id3, '11/05/2023', first_score, 'rebuilt' from scored""")
    add("map_at_5", ["scored"], """
        select count(*) as customers, round(avg(ap), 6) as map_at_5 from (
            select id2, sum(case when r <= 5 then y * hits / r::double else 0 end)
                       / least(sum(y), 5) as ap
            from (select *, sum(y) over (partition by id2 order by first_score desc, id1
                                         rows unbounded preceding) as hits
                  from (select *, row_number() over (partition by id2
                            order by first_score desc, id1) as r from scored))
            group by id2 having sum(y) > 0)""")
    add("feature_table", ["impressions", "offers", "counts", "rfm"], """
        select i.id1, cast(i.id2 as varchar) as id2, i.id3, i.id4,
               cast(i.id5 as varchar) as id5, i.f1, i.y, o.id9, o.id10, o.id11, o.id12, o.id13, o.f376,
               coalesce(c.past_impression_count, 0) as past_impression_count,
               coalesce(r.recency, 0) as recency, coalesce(r.frequency, 0) as frequency,
               round(coalesce(r.monetary, 0), 2) as monetary
        from impressions i left join offers o on i.id3 = o.id3
        left join counts c on i.id2 = c.id2 and i.id3 = c.id3
        left join rfm r on i.id2 = r.id2""")
    add("training_table", ["train", "meta", "spending"],
        f"select j.id1, j.id2, j.id3, cast(j.id5 as varchar) as id5, j.f1, j.y, {PARTS.replace('id4)', 'j.id4)')}, "
        "coalesce(j.is_currently_active, 0) as is_currently_active, coalesce(j.f376, 0) as f376, "
        + ", ".join(f"coalesce(c_{n}.code, -1) as {n}" for n in names) + f", {SPENDING} "
        + "from joined j " + " ".join(f"left join c_{n} on j.{n} = c_{n}.v" for n in names)
        + " left join spending s on j.id2 = s.id2",
        ",\n".join([JOINED, *[_classes(f"c_{n}", "joined", n) for n in names]]))
    add("gbt_scores", ["impressions"],
        "select id1, id2, id3, y, true as in_range from impressions where id5 >= date '2024-01-24'")
    add("ensemble_scores", ["impressions"], """
        select id1, id2, id3, y, true as first_in_range, true as second_in_range, true as is_blend
        from impressions where id5 >= date '2024-01-24'""")
    # features: f1, five parts of a date, seven offer columns without the id, three of spending
    add("top_importance", [], """
        select cast(r as integer) as rank, true as falls, true as adds_up
        from range(1, 16) t(r)""")
    add("submission", ["test"], """
        select cast(id1 as varchar) as id1, id2, id3, strftime(id5, '%m/%d/%Y') as id5, true as in_range
        from test""")
    add("rf_scores", ["test"],
        "select id1, id2, id3, true as in_range, true as is_label from test")
    add("ranker_scores", ["test"],
        "select id1, id2, id3, true as in_range, true as is_scaled from test")
    add("join_collisions", ["impressions", "offers", "spending"], """
        select i.id1, i.id2, i.id3, i.f1 as f376_x, coalesce(o.f376, -5) as f376_y,
               coalesce(o.id9, 'none') as trans_cnt_x, coalesce(s.trans_cnt, 0) as trans_cnt_y
        from impressions i left join offers o on i.id3 = o.id3 left join spending s on i.id2 = s.id2""")
    add("variance_with_nan", ["impressions"], """
        select 'f1' as feature, round(var_pop(f1), 6) as variance, var_pop(f1) > 1e-5 as kept
        from impressions where id1 % 7 <> 0
        union all select 'constant', cast(0 as double), false""")
    add("numeric_rule_types", ["impressions"], f"""
        select id1, cast(f1 > 20 as integer) as flag, round(f1, 6) as f1,
               cast(1 - y as bigint) as word, {PARTS} from impressions""")
    add("infer_date_format", ["impressions"], """
        select id1, case when id1 % 5 = 0 then null else date_trunc('day', id4)::timestamp end as parsed
        from impressions""")
    add("template_by_row", ["test", "scored"], """
        select t.id1, t.id2, t.id3, cast(s.first_score > 0.5 as integer) as pred
        from test t join scored s on t.id1 = s.id1""")
    add("csv_round_trip", ["impressions"], "select id1, id2, id3, id4, f1, y from impressions")
    add("dictionary_comments", [], """
        select 'f' || p_partkey as masked_column, p_name || ', "quoted"' as "Description",
               'Numerical' as "Type",
               case when p_partkey between 1 and 366 and p_partkey <> 218 then trim(p_name) || ', "quoted"' end as comment
        from part""")
    add("bundle_round_trip", ["test"], "select id1, true as same from test")
    add("strict_timestamp", ["impressions"],
        "select id1, date_trunc('second', id4)::timestamp as parsed from impressions")
    add("target_choice", ["impressions"], 'select id1, 1 - y as "both", y as one from impressions')
    add("sorted_rows", ["impressions"], """
        select id1, cast(id5 as varchar) as id5, row_number() over (order by id5, id1) as position
        from impressions""")
    add("past_impressions_before", ["impressions"], """
        select id1, id2, id3, coalesce(sum(seen) over (
            partition by id2, id3 order by id4 range between unbounded preceding and interval 1 microsecond preceding),
            0)::bigint as past_impression_count
        from (select i.*, case when e.event_type in ('view', 'click') then 1 else 0 end as seen
              from impressions i join events e on e.event_id = i.id1)""")
    add("balanced_folds", ["impressions"], """
        select i.id1, i.id2, g.fold from impressions i join (
            select id2, cast((sum(n) over (order by n desc, id2) - n) * 5 // sum(n) over () as integer) as fold
            from (select id2, count(*) as n from impressions group by id2)) g on g.id2 = i.id2""")
    add("balanced_folds_large", ["impressions"], """
        select i.id1, i.id2 * i.id2 % 7 as "group", p.fold
        from impressions i join placed p on p.g = i.id2 * i.id2 % 7 where p.step > 0""", """
    ranked as (
        select g, n, row_number() over (order by n desc, g) as step from (
            select id2 * id2 % 7 as g, count(*) as n from impressions group by 1)),
    placed as (
        select cast(0 as bigint) as step, cast(null as bigint) as g, -1 as fold, [0, 0, 0]::bigint[] as loads
        union all
        select r.step, r.g, cast(list_position(p.loads, list_min(p.loads)) - 1 as integer),
               list_transform(p.loads, lambda x, i: case when i = list_position(p.loads, list_min(p.loads))
                   then x + r.n else x end)
        from placed p join ranked r on r.step = p.step + 1)""")
    q["balanced_folds_large"] = q["balanced_folds_large"].replace("with ", "with recursive ", 1)
    add("exact_split", ["impressions"], """
        select id1, case when row_number() over (order by ('0x' || left(md5(id1 || ':42'), 8))::bigint, id1)
            <= ceil(0.2 * count(*) over ()) then 'valid' else 'train' end as part from impressions""")
    add("csv_types", ["impressions"], """
        select id1, f1, y = 1 as flag, 'w' || id2 as word, case when id1 % 3 = 0 then id3 end as some
        from impressions""")
    add("template_by_position", ["scored"], """
        select id1 as tag, id2, id3, round(first_score, 6) as pred, true as matched from scored""")
    add("booster_tree", ["impressions"],
        "select id1, round(base + weight, 5) as score from leaves join weights using (leaf)", LOGISTIC)
    add("booster_gains", ["impressions"], """
        select x.f as feature, round(coalesce(sum(s.gain), 0), 3) as gain, count(s.gain) as splits
        from (select unnest(['a', 'b', 'c']) as f) x
        left join (select f, gain from split1 union all select f, gain from split2) s on s.f = x.f group by x.f""", LOGISTIC)
    add("ranker_tree", ["impressions"],
        "select id1, round(base + weight, 6) as score from leaves join weights using (leaf)", LISTWISE)
    add("first_rows", ["scored"],
        "select id1, first_score from scored order by first_score desc, id1 limit 3")
    return q


ORACLE = _build()
