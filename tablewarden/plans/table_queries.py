"""Comparison, profiles, dimensions and record standardisation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Window, functions as F

from ..operators import compare, dimensions, profile, standardise
from ..session import new_shared_path
from .inputs import TABLES
from .registry import Tables, query

LOADS = ("load_1", "load_2")


@query(
    "compare_summary",
    """select (select count(*) from load_1) as first_count, (select count(*) from load_2) as second_count,
         (select count(distinct c_custkey) from load_1 where c_custkey not in (select c_custkey from load_2)) as only_in_first,
         (select count(distinct c_custkey) from load_2 where c_custkey not in (select c_custkey from load_1)) as only_in_second""",
    LOADS,
)
def _(t: Tables):
    return compare.compare_summary(t.load_1, t.load_2, ["c_custkey"])


@query("compare_only_first", "select * from load_1 f where not exists (select 1 from load_2 s where s.c_custkey = f.c_custkey)", LOADS)
def _(t: Tables):
    return compare.only_in_first(t.load_1, t.load_2, ["c_custkey"])


@query("compare_only_second", "select * from load_2 s where not exists (select 1 from load_1 f where s.c_custkey = f.c_custkey)", LOADS)
def _(t: Tables):
    return compare.only_in_second(t.load_1, t.load_2, ["c_custkey"])


@query(
    "data_difference",
    """select 'segment' as differing_columns, f.c_custkey as f_c_custkey, s.c_custkey as s_c_custkey, f.segment as f_segment,
         s.segment as s_segment, f.c_nationkey as f_c_nationkey, s.c_nationkey as s_c_nationkey
       from load_1 f join load_2 s on s.c_custkey = f.c_custkey where f.segment is distinct from s.segment""",
    LOADS,
)
def _(t: Tables):
    return compare.data_difference(t.load_1, t.load_2, ["c_custkey"])


LINE_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                "l_returnflag", "l_linestatus", "l_shipdate")
CHANGED_LINES = "case when l_shipdate >= timestamp '2001-01-01' then 'X' else l_returnflag end as l_returnflag"

LINE_MARK = "md5(concat_ws('|', ':' || l_orderkey, ':' || l_partkey, ':' || l_returnflag))"


@query(
    "row_difference",
    f"""with f as (select {', '.join(LINE_COLUMNS)}, count(*) as n from lineitem group by all),
         s as (select {', '.join(CHANGED_LINES if c == 'l_returnflag' else c for c in LINE_COLUMNS)}, count(*) as n from lineitem group by all)
       select {', '.join(f'coalesce(f.{c}, s.{c}) as {c}' for c in LINE_COLUMNS)},
         coalesce(f.n, 0) as first_count, coalesce(s.n, 0) as second_count
       from f full join s on {' and '.join(f'f.{c} = s.{c}' for c in LINE_COLUMNS)}
       where coalesce(f.n, 0) <> coalesce(s.n, 0)""",
)
def _(t: Tables):
    after = t.lineitem.withColumn("l_returnflag", F.expr(CHANGED_LINES.replace("timestamp", "timestamp_ntz").rpartition(" as ")[0]))
    return compare.row_difference(t.lineitem, after.select(*t.lineitem.columns))


@query(
    "data_difference_repeated",
    f"""with f as (select l_orderkey, l_partkey, l_returnflag from lineitem),
         s as (select l_orderkey, l_partkey, {CHANGED_LINES} from lineitem where l_linenumber <> 3),
         held as (select l_orderkey from f intersect select l_orderkey from s),
         fo as (select * from f except all select * from s), so as (select * from s except all select * from f),
         fp as (select *, row_number() over (partition by l_orderkey order by {LINE_MARK}) as at from fo where l_orderkey in (from held)),
         sp as (select *, row_number() over (partition by l_orderkey order by {LINE_MARK}) as at from so where l_orderkey in (from held))
       select concat_ws(' ', case when fp.l_partkey is distinct from sp.l_partkey then 'l_partkey' end,
           case when fp.l_returnflag is distinct from sp.l_returnflag then 'l_returnflag' end) as differing_columns,
         fp.l_orderkey as f_l_orderkey, sp.l_orderkey as s_l_orderkey, fp.l_partkey as f_l_partkey, sp.l_partkey as s_l_partkey,
         fp.l_returnflag as f_l_returnflag, sp.l_returnflag as s_l_returnflag
       from fp full join sp on sp.l_orderkey = fp.l_orderkey and sp.at = fp.at""",
)
def _(t: Tables):
    """A key that names several rows on both sides: every order's lines, some changed and one line missing."""
    after = t.lineitem.withColumn("l_returnflag", F.expr(CHANGED_LINES.replace("timestamp", "timestamp_ntz").rpartition(" as ")[0]))
    kept = ["l_orderkey", "l_partkey", "l_returnflag"]
    return compare.data_difference(
        t.lineitem.select(*kept), after.filter("l_linenumber <> 3").select(*kept), ["l_orderkey"])


@query(
    "version_difference",
    """select 'segment' as differing_columns, f.c_custkey as f_c_custkey, s.c_custkey as s_c_custkey,
         f.segment as f_segment, s.segment as s_segment
       from load_1 f join load_2 s on s.c_custkey = f.c_custkey where f.segment is distinct from s.segment""",
    LOADS,
)
def _(t: Tables):
    return compare.version_difference(t.load_1, t.load_2, ["c_custkey"], ignore=["c_nationkey"])


@query(
    "schema_drift",
    """select i.schema_name, i.relation_name, i.column_name, i.data_type as public_data_type, i.char_length as public_length,
         h.data_type as history_data_type, h.char_length as history_length,
         case i.data_type when 'varchar' then 'varchar(' || cast(i.char_length as varchar) || ')' when 'decimal' then 'decimal(18,2)'
           else i.data_type end as corrective_type
       from part_inventory i join (
         select relation_name, column_name, schema_name, case when size > 35 then 'varchar' else data_type end as data_type,
           case when size <= 5 then 50 else char_length end as char_length
         from part_inventory join part_column using (schema_name, relation_name, column_name)) h
       on h.relation_name = i.relation_name and h.column_name = i.column_name
       where h.data_type <> i.data_type or h.char_length <> i.char_length""",
    ("part_inventory", "part_column"),
)
def _(t: Tables):
    held = t.part_inventory.join(t.part_column, ["schema_name", "relation_name", "column_name"]).select(
        "schema_name",
        "relation_name",
        "column_name",
        F.when(F.col("size") > 35, "varchar").otherwise(F.col("data_type")).alias("data_type"),
        F.when(F.col("size") <= 5, 50).otherwise(F.col("char_length")).alias("char_length"),
    )
    return compare.schema_drift(t.part_inventory, held)


ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
PROFILE_SQL = "\nunion all\n".join(
    f"select '{c}' as column_name, count(distinct {c}) as distinct_values, {i} as ordinal from orders"
    for i, c in enumerate(ORDER_COLUMNS, 1)
)


@query("distinct_profile", PROFILE_SQL)
def _(t: Tables):
    return profile.distinct_profile(t.orders)


@query("distinct_profile_approximate")
def _(t: Tables):
    return profile.distinct_profile(t.orders, approximate=True)


@query(
    "distinct_profile_error",
    f"select column_name, true as within_bound from ({PROFILE_SQL}) p",
)
def _(t: Tables):
    """The sketches against the exact counts: within four standard errors (5 %) of each column's count."""
    close = F.abs(F.col("a.distinct_values") - F.col("e.distinct_values")) <= F.greatest(
        F.lit(1.0), F.col("e.distinct_values") * 0.2)
    approximate, exact = profile.distinct_profile(t.orders, approximate=True), profile.distinct_profile(t.orders)
    return approximate.alias("a").join(exact.alias("e"), "column_name").select("column_name", close.alias("within_bound"))


EVENT_DAYS = (date(2024, 1, 5), date(2024, 1, 20))
EVENT_COLUMNS = ("event_id", "user_id", "event_type", "value")


@query(
    "profile_over_days",
    "\nunion all\n".join(
        f"select '{c}' as column_name, {i} as ordinal, count(*) as row_count, count({c}) as filled_rows, true as within_bound "
        f"from events where cast(ts as date) between date '{EVENT_DAYS[0]}' and date '{EVENT_DAYS[1]}' having count(*) > 0"
        for i, c in enumerate(EVENT_COLUMNS, 1)),
)
def _(t: Tables):
    """Sketches of all days stored once, a range of days merged from them, and its estimates held against exact counts:
    within five standard errors (8 %)."""
    path = new_shared_path(t.spark, "profile")
    events = t.events.select("ts", *EVENT_COLUMNS)
    profile.store_profile(events, "ts", path)
    merged = profile.profile_of_days(t.spark.read.parquet(path), *EVENT_DAYS)
    exact = profile.distinct_profile(events.filter(F.to_date("ts").between(*EVENT_DAYS)).select(*EVENT_COLUMNS))
    close = F.abs(F.col("m.distinct_values") - F.col("e.distinct_values")) <= F.greatest(
        F.lit(1.0), F.col("e.distinct_values") * 0.08)
    return merged.alias("m").join(exact.alias("e"), "column_name").select(
        "column_name", "m.ordinal", "row_count", "filled_rows", close.alias("within_bound"))


@query(
    "storage_order",
    f"""with profile as ({PROFILE_SQL})
        select string_agg('[' || column_name || ']', ', ' order by distinct_values, ordinal) as order_clause from profile""",
)
def _(t: Tables):
    return profile.storage_order(profile.distinct_profile(t.orders))


@query(
    "clustered_table",
    f"""with profile as ({PROFILE_SQL})
        select (select count(*) from orders) as row_count, 0 as rows_out_of_order,
          (select string_agg(column_name, ',' order by distinct_values, ordinal) from profile) as sort_order""",
)
def _(t: Tables):
    """The stored order itself: rows that come before their predecessor in the same file."""
    path = new_shared_path(t.spark, "clustered")
    order = profile.cluster_by_cardinality(t.orders, path)
    stored = t.spark.read.parquet(path).select(
        F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"),
        F.struct(*[F.col(f"`{c}`") for c in order]).alias("row"),
    )
    before = F.lag("row").over(Window.partitionBy("file").orderBy("at"))
    checked = stored.withColumn("late", F.col("row") < before)
    return checked.agg(
        F.count("*").alias("row_count"), F.count_if("late").cast("int").alias("rows_out_of_order")
    ).withColumn("sort_order", F.lit(",".join(order)))


@query(
    "row_search",
    """select row_text from (
         select concat_ws('||', cast(p_partkey as varchar), p_name, p_brand, p_type, cast(p_size as varchar),
           cast(p_retailprice as varchar)) as row_text from part) p
       where contains(row_text, 'ring||Brand#1')""",
)
def _(t: Tables):
    return profile.row_search(t.part, "ring||Brand#1")


FOOTPRINT_MB = 0.02


@query("footprint")
def _(t: Tables):
    """Files and megabytes of every table from a threshold on; sizes have no SQL form, rows are in ``footprint_rows``."""
    return profile.footprint({("public", n): getattr(t, n) for n in TABLES}, minimum_mb=FOOTPRINT_MB)


@query(
    "footprint_rows",
    "\nunion all\n".join(
        f"select 'public' as schema_name, '{n}' as relation_name, count(*) as row_count from {n} having count(*) > 0" for n in TABLES),
)
def _(t: Tables):
    tables = {("public", n): getattr(t, n) for n in TABLES}
    return profile.footprint(tables, minimum_mb=0).select("schema_name", "relation_name", "row_count")


# Dimensions over the days and seconds that occur in the tables, with what happened on them.

# Names of months and weekdays.
MONTHS_SQL = "['Janúar', 'Febrúar', 'Mars', 'Apríl', 'Maí', 'Júní', 'Júlí', 'Ágúst', 'September', 'Október', 'Nóvember', 'Desember']"
WEEKDAYS_SQL = "['Mánudagur', 'Þriðjudagur', 'Miðvikudagur', 'Fimmtudagur', 'Föstudagur', 'Laugardagur', 'Sunnudagur']"


@query(
    "date_dimension",
    f"""
    with bounds as (select cast(min(o_orderdate) as date) as low, cast(max(o_orderdate) as date) as high from orders),
    days as (select cast(low + cast(n as int) as date) as id from bounds, lateral (select unnest(range(0, (high - low) + 1)) as n) r),
    parts as (
      select id, cast(isodow(id) as int) as weekday, cast(month(id) as int) as month, cast(year(id) as int) as year,
        cast(quarter(id) as int) as quarter, cast(day(id) as int) as day_of_month, cast(dayofyear(id) as int) as day_of_year,
        cast(week(id) as int) as iso_week_of_year, cast(date_trunc('month', id) as date) as month_start,
        make_date(year(id), 1, 1) as year_start, make_date(year(id), 12, 31) as year_end from days),
    weeks as (
      select *, cast((day_of_year - 1 + isodow(year_start) - 1) // 7 + 1 as int) as week_of_year,
        cast((dayofyear(year_end) - 1 + isodow(year_start) - 1) // 7 + 1 as int) as last_week from parts),
    orders_per_day as (select cast(o_orderdate as date) as id, count(*) as order_count from orders group by 1)
    select id, weekday, {WEEKDAYS_SQL}[weekday] as weekday_name, cast(weekday > 5 as int) as is_weekend, cast(weekday <= 5 as int) as is_workday,
      week_of_year, iso_week_of_year, cast(row_number() over (partition by year, month, weekday order by id) as int) as weekday_of_month,
      id - (weekday - 1) as week_start, id + (7 - weekday) as week_end,
      cast(dense_rank() over (partition by year, month order by week_of_year) as int) as week_of_month, day_of_month, month, month_start,
      max(id) over (partition by year, month) as month_end, {MONTHS_SQL}[month] as month_name, left({MONTHS_SQL}[month], 3) as month_short_name,
      cast(month_start + interval 1 month as date) as next_month_start, cast(month_start + interval 2 month as date) - 1 as next_month_end,
      quarter, min(id) over (partition by year, quarter) as quarter_start, max(id) over (partition by year, quarter) as quarter_end, year,
      case when month = 1 and iso_week_of_year > 51 then year - 1 when month = 12 and iso_week_of_year = 1 then year + 1 else year end as iso_year,
      cast(year % 400 = 0 or (year % 4 = 0 and year % 100 <> 0) as int) as is_leap_year, day_of_year, year_start, year_end,
      cast(last_week = 53 as int) as has_53_weeks, cast(week(year_end) = 53 as int) as has_53_iso_weeks, strftime(id, '%Y-%m') as year_month,
      coalesce(order_count, 0) as order_count
    from weeks left join orders_per_day using (id)""",
)
def _(t: Tables):
    calendar = dimensions.date_dimension(dimensions.days_of(t.orders, "o_orderdate"))
    per_day = t.orders.groupBy(F.to_date("o_orderdate").alias("id")).agg(F.count("*").alias("order_count"))
    return calendar.join(per_day, "id", "left").withColumn("order_count", F.coalesce("order_count", F.lit(0).cast("bigint")))


@query(
    "time_dimension",
    """
    with seconds as (select cast(unnest(range(0, 86400)) as int) as s),
    parts as (select s // 3600 as hour, s // 60 % 60 as minute, s % 60 as second from seconds),
    per_second as (select strftime(ts, '%H:%M:%S') as id, count(*) as event_count from events group by 1),
    named as (select printf('%02d:%02d:%02d', hour, minute, second) as id, * from parts)
    select id, hour, minute, second, cast(hour between 8 and 17 as int) as is_daytime, cast(hour between 0 and 5 as int) as is_night,
      cast(hour between 6 and 9 as int) as is_morning, cast(hour between 18 and 23 as int) as is_evening,
      coalesce(event_count, 0) as event_count
    from named left join per_second using (id)""",
)
def _(t: Tables):
    per_second = t.events.groupBy(F.date_format("ts", "HH:mm:ss").alias("id")).agg(F.count("*").alias("event_count"))
    seconds = dimensions.time_dimension(t.spark).join(per_second, "id", "left")
    return seconds.withColumn("event_count", F.coalesce("event_count", F.lit(0).cast("bigint")))


# Record standardisation.

# Fixed value: the punctuation that constructed keys replace.
KEY_SQL = """translate(coalesce(upper({a}), 'NULL') || '_' || coalesce(upper({b}), 'NULL'),
    ' .,:;-/?!()[]*#$%&=@><|^~"', '__________________________')"""


@query(
    "construct_keys",
    f"select c_custkey, segment, email, {KEY_SQL.format(a='segment', b='email')} as constructed_key from customer_dirty",
    ("customer_dirty",),
)
def _(t: Tables):
    rows = t.customer_dirty.select("c_custkey", "segment", "email")
    return standardise.construct_keys(rows, ["segment", "email"])


@query(
    "construct_key_collisions",
    f"""select constructed_key, count(*) as input_count from (
          select distinct p_type, p_name, {KEY_SQL.format(a='p_type', b='p_name')} as constructed_key from (
            select p_type, case when p_size < 25 then replace(p_name, ' ', '-') else p_name end as p_name from part) p) k
        group by constructed_key having count(*) > 1""",
)
def _(t: Tables):
    spelled = t.part.selectExpr("p_type", "case when p_size < 25 then replace(p_name, ' ', '-') else p_name end as p_name")
    return standardise.key_collisions(spelled, ["p_type", "p_name"])


@query(
    "surrogate_keys",
    """select l_orderkey, l_linenumber, l_returnflag,
         md5(cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) || '-' || coalesce(nullif(l_returnflag, 'N'), '')) as surrogate_key
       from lineitem""",
)
def _(t: Tables):
    lines = t.lineitem.selectExpr("l_orderkey", "l_linenumber", "l_returnflag", "nullif(l_returnflag, 'N') as flag")
    return standardise.surrogate_keys(lines, ["l_orderkey", "l_linenumber", "flag"]).drop("flag")


@query(
    "standardise_phones",
    """
    with bare as (select c_custkey, phone, replace(replace(replace(phone, '-', ''), '+', ''), ' ', '') as d,
        replace(replace(phone, '-', ''), ' ', '') as m from customer_dirty),
    cut as (select *, case when length(d) > 2 and starts_with(d, '00') then substr(d, 3) else d end as e from bare),
    full_numbers as (select c_custkey, phone, case when length(e) < 10 then '354' || e else e end as e164,
        case when length(m) = 7 then '354' || m else m end as m from cut)
    select c_custkey, phone, e164, case when starts_with(m, '+') then m else '+' || m end as msisdn,
      case when e164 is null then 'missing' when not regexp_matches(e164, '^[0-9]{10,15}$') then 'shape'
        when not exists (select 1 from country_code k where starts_with(e164, k.code)) then 'country code' end as reason
    from full_numbers""",
    ("customer_dirty", "country_code"),
)
def _(t: Tables):
    return standardise.standardise_phones(t.customer_dirty.select("c_custkey", "phone"), "phone", t.country_code, "code")


@query(
    "conform_dates",
    """with cut as (select *, try_cast(substr(trim(raw), 5, 4) || '-' || substr(trim(raw), 3, 2) || '-' || substr(trim(raw), 1, 2) as date) as d
         from raw_dates)
       select o_orderkey, raw, case when length(trim(raw)) >= 8 then d end as conformed_date,
         case when raw is null then 'missing' when length(trim(raw)) < 8 then 'too short' when d is null then 'invalid' end as reason
       from cut""",
    ("raw_dates",),
)
def _(t: Tables):
    return standardise.conform_dates(t.raw_dates, "raw", "DDMMYYYY")


@query(
    "conform_times",
    """with read as (select *, case raw when '5' then '00:05:00' when '930' then '09:30:00' when '1230' then '12:30:00'
           when '123015' then '12:30:15' else '23:59:59' end as conformed_time from raw_times)
       select *, cast(substr(conformed_time, 1, 2) as int) * 3600 + cast(substr(conformed_time, 4, 2) as int) * 60
           + cast(substr(conformed_time, 7, 2) as int) as second_of_day,
         case when raw is null then 'missing' when raw = '99:99' then 'invalid' end as reason from read""",
    ("raw_times",),
)
def _(t: Tables):
    return standardise.conform_times(t.raw_times, "raw", "23:59:59")


@query(
    "person_attributes",
    """
    with read as (
      select c_custkey, national_id, regexp_matches(national_id, '^[0-7][0-9]{9}$') as ok,
        try_cast(substr(national_id, 1, 1) as int) as f, substr(national_id, 2, 1) as d2, substr(national_id, 3, 2) as m,
        case substr(national_id, 10, 1) when '8' then '18' when '9' then '19' when '0' then '20' end || substr(national_id, 5, 2) as y,
        case when c_acctbal < 0 then '3' when c_acctbal < 1000 then '1' end as code
      from customer_dirty),
    dated as (select *, cast(case when f < 4 then f else f - 4 end as varchar) || d2 as d from read),
    born as (
      select c_custkey, national_id, code, case when not ok then null
        when try_cast(y || '-' || m || '-' || d as date) is not null then try_cast(y || '-' || m || '-' || d as date)
        when m = '02' and d > '28' then try_cast(y || '-02-28' as date) end as birthday from dated),
    aged as (select *, cast(floor((date '2024-06-30' - birthday) / 365.2425) as int) as age from born)
    select c_custkey, national_id, code, birthday, age,
      case when code = '3' then 0 when code is not null then 1 when age < 18 then 0 else 1 end as of_legal_age from aged""",
    ("customer_dirty",),
)
def _(t: Tables):
    people = t.customer_dirty.selectExpr(
        "c_custkey", "national_id", "case when c_acctbal < 0 then '3' when c_acctbal < 1000 then '1' end as code"
    )
    return standardise.person_attributes(people, "national_id", date(2024, 6, 30), "code").drop("reason")


@query(
    "split_names",
    """select p_partkey, name, split_part(name, ' ', 1) as first_name,
         case when len(words) = 1 then name else array_to_string(words[2:len(words) - 1], ' ') end as middle_name, words[-1] as last_name
       from (select *, string_split(name, ' ') as words from person_name) n""",
    ("person_name",),
)
def _(t: Tables):
    return standardise.split_names(t.person_name, "name")


@query(
    "house_number_ranges",
    """select s_suppkey, house,
         case when s_suppkey % 6 in (3, 4) then null else cast(s_suppkey as int) end as house_from,
         case s_suppkey % 6 when 0 then cast(s_suppkey + 4 as int) when 2 then cast(s_suppkey + 2 as int)
           when 3 then null when 4 then null else cast(s_suppkey as int) end as house_to,
         case s_suppkey % 6 when 4 then 'missing' when 3 then 'not numeric' end as reason
       from house""",
    ("house",),
)
def _(t: Tables):
    return standardise.house_number_ranges(t.house, "house")


@query(
    "resolve_country",
    """select p.*, case when length(postal_code) = 3 then (select min(id) from country where alpha_2_code = 'is')
         else coalesce(c.id, n.id) end as country_id
       from person_place p
       left join (select alpha_2_code, min(id) as id from country group by 1) c
         on c.alpha_2_code = lower(substr(coalesce(community_code, '0000'), 3, 2))
       left join (select lower(name) as name, min(id) as id from country group by 1) n on n.name = lower(p.address)""",
    ("person_place", "country"),
)
def _(t: Tables):
    return standardise.resolve_country(t.person_place, t.country, "postal_code", "community_code", "address")


@query(
    "fuzzy_match",
    """with names as (select lower(p_name) as v, count(*) as n from part group by 1),
         words as (select lower(replace(p_name, ' ', '')) as v, count(*) as n from part group by 1)
       select a.v as left_value, b.v as right_value, cast(levenshtein(a.v, b.v) as int) as distance, a.n as left_rows, b.n as right_rows
       from names a join words b on levenshtein(a.v, b.v) <= 2""",
)
def _(t: Tables):
    squeezed = t.part.select(F.replace("p_name", F.lit(" "), F.lit("")).alias("word"))
    return standardise.fuzzy_match(t.part, "p_name", squeezed, "word", 2)


def _blocked_sql(blocks: str, limit: str = "") -> str:
    return f"""with names as (select {blocks}, lower(p_name) as v, count(*) as n from part group by all),
         types as (select {blocks}, lower(p_type) as v, count(*) as n from part group by all)
       select {blocks}, a.v as left_value, b.v as right_value, cast(levenshtein(a.v, b.v) as int) as distance,
         a.n as left_rows, b.n as right_rows
       from names a join types b using ({blocks}) {limit}"""


@query("fuzzy_match_blocked", _blocked_sql("p_brand, p_size"))
def _(t: Tables):
    return standardise.fuzzy_match_blocked(t.part, "p_name", t.part, "p_type", ["p_brand", "p_size"], chunk=4)


@query(
    "fuzzy_match_blocked_limit",
    _blocked_sql("p_brand", "where levenshtein(a.v, b.v) <= 2").replace("p_type", "replace(p_name, ' ', '')"),
)
def _(t: Tables):
    squeezed = t.part.select("p_brand", F.replace("p_name", F.lit(" "), F.lit("")).alias("word"))
    return standardise.fuzzy_match_blocked(t.part, "p_name", squeezed, "word", ["p_brand"], 2)


@query(
    "quarantine_counts",
    """select case when raw is null then 'missing' when raw = '1201' then 'too short' when raw = '31021999' then 'invalid' else 'ok' end as reason,
         count(*) as row_count from raw_dates group by 1""",
    ("raw_dates",),
)
def _(t: Tables):
    return standardise.quarantine_counts(standardise.conform_dates(t.raw_dates, "raw", "DDMMYYYY"))
