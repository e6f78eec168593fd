"""Inputs the queries run on: the supplied tables and relations derived from all of their rows.

A derived relation is one SQL text that Spark and the checking database both run unchanged, so both sides start
from the same rows. Faults are planted in values. Rows differ from the source's only where an operator compares two
states of a table (an earlier and a later load, a history with gaps).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@dataclass(frozen=True)
class Derived:
    needs: tuple[str, ...]
    sql: str


DERIVED = {
    # Customers with missing, empty and malformed values.
    "customer_dirty": Derived(("customer",), """
        select c_custkey, c_name, c_acctbal,
          case when c_custkey % 11 = 0 then null when c_custkey % 13 = 0 then '' else c_mktsegment end as segment,
          case when c_custkey % 17 = 0 then 99 when c_custkey % 19 = 0 then null else c_nationkey end as nationkey,
          case c_custkey % 9 when 0 then null when 1 then 'a b@mail.example.com' when 2 then 'user.example.com'
            when 3 then 'u@@mail.example.com' when 4 then '-u' || cast(c_custkey as string) || '@mail.example.com'
            when 5 then ' u' || cast(c_custkey as string) || '@mail.example.com '
            else 'u' || cast(c_custkey as string) || '@mail.example.com' end as email,
          case c_custkey % 7 when 0 then null when 1 then '+354 ' || lpad(cast(c_custkey as string), 7, '5')
            when 2 then '00354' || lpad(cast(c_custkey as string), 7, '5')
            when 3 then '999' || lpad(cast(c_custkey as string), 9, '5') when 4 then 'abc'
            else '354' || lpad(cast(c_custkey as string), 7, '5') end as phone,
          case when c_custkey % 23 = 0 then null when c_custkey % 29 = 0 then '12345'
            when c_custkey % 31 = 0 then '12345x7890'
            else lpad(cast((c_custkey * 6700417) % 10000000000 as string), 10, '0') end as national_id
        from {customer}"""),
    "country_code": Derived((), "select * from (values ('354', 'IS'), ('47', 'NO'), ('1', 'US'), ('99955', 'X1'), ('9995', 'X2')) as t(code, alpha2)"),
    # Daily state of every user that was active on the day.
    "user_state_history": Derived(("events",), """
        select cast(ts as date) as snap_date, user_id, max_by(event_type, event_id) as event_type,
          max_by(value, event_id) as value
        from {events} group by cast(ts as date), user_id"""),
    "early_history": Derived(("user_state_history",), """
        select * from {user_state_history} where snap_date < date '2024-01-20'"""),
    "gappy_history": Derived(("user_state_history",), """
        select * from {user_state_history}
        where snap_date < date '2024-01-10' or snap_date between date '2024-01-15' and date '2024-01-20'"""),
    "late_history": Derived(("user_state_history",), """
        select * from {user_state_history} where snap_date >= date '2024-01-08'"""),
    "partial_history": Derived(("user_state_history",), """
        select * from {user_state_history}
        where not (snap_date between date '2024-01-11' and date '2024-01-13' and event_type = 'error')"""),
    # Two loads of one table: accounts from 9000 are new in the second, negative ones are gone, nation 3 changed.
    "load_1": Derived(("customer",), """
        select c_custkey, nullif(c_mktsegment, 'BUILDING') as segment, c_nationkey from {customer}
        where c_acctbal < 9000"""),
    "load_2": Derived(("customer",), """
        select c_custkey, case when c_nationkey = 3 then 'CHANGED' when c_nationkey = 4 then c_mktsegment
          else nullif(c_mktsegment, 'BUILDING') end as segment, c_nationkey from {customer}
        where c_acctbal >= 0"""),
    "raw_dates": Derived(("orders",), """
        select o_orderkey, case o_orderkey % 5 when 0 then null when 1 then '31021999' when 2 then '1201'
          else lpad(cast(extract(day from o_orderdate) as string), 2, '0')
            || lpad(cast(extract(month from o_orderdate) as string), 2, '0')
            || cast(extract(year from o_orderdate) as string) end as raw from {orders}"""),
    "raw_times": Derived(("events",), """
        select event_id, case event_id % 6 when 0 then null when 1 then '5' when 2 then '930' when 3 then '1230'
          when 4 then '123015' else '99:99' end as raw from {events}"""),
    "person_name": Derived(("part",), """
        select p_partkey, case p_partkey % 3 when 0 then p_name || ' ' || p_type when 1 then p_name
          else p_brand end as name from {part}"""),
    "house": Derived(("supplier",), """
        select s_suppkey, case s_suppkey % 6 when 0 then cast(s_suppkey as string) || '-' || cast(s_suppkey + 4 as string)
          when 1 then cast(s_suppkey as string) || 'a'
          when 2 then cast(s_suppkey as string) || ' og ' || cast(s_suppkey + 2 as string)
          when 3 then 'abc' when 4 then null else cast(s_suppkey as string) || '-' end as house from {supplier}"""),
    # Tables with version suffixes in their names.
    "table_name": Derived(("supplier",), """
        select s_suppkey, case when s_nationkey < 8 then 'Relation' || cast(s_suppkey as string)
            || '_v' || cast(s_nationkey as string)
          when s_nationkey < 16 then 'relation_' || cast(s_suppkey as string) || '_V1' || cast(s_nationkey as string)
          when s_nationkey < 20 then 'relation_vx' || cast(s_suppkey as string) else 'relation' end as name
        from {supplier}"""),
    "person_place": Derived(("customer", "nation"), """
        select c.c_custkey,
          case when c.c_acctbal < 0 then '101' when c.c_acctbal < 5000 then '1010' else null end as postal_code,
          case when c.c_acctbal < 2000 then null when c.c_acctbal < 4000 then '00NO'
            when c.c_acctbal < 4500 then '00ZZ' else null end as community_code,
          n.n_name as address
        from {customer} c join {nation} n on n.n_nationkey = c.c_nationkey"""),
    "country": Derived(("nation",), """
        select 'country-' || coalesce(code, 'of ' || name) as id, code as alpha_2_code, name from (
          select case n_nationkey when 0 then 'is' when 1 then 'no' when 2 then 'us'
            when 5 then null when 6 then 'fx' else chr(97 + n_nationkey) || 'x' end as code, lower(n_name) as name from {nation}) n
        union all select 'country-other', 'fx', 'other name of ' || n_name from {nation} where n_nationkey = 6"""),
    # A catalog of relations whose columns are named after the parts.
    "part_column": Derived(("part",), """
        select 'warehouse' as database_name, schema_name, relation_name, column_name,
          'model.' || schema_name || '.' || relation_name as node_key,
          min(p_size) as size, min(cast(replace(p_brand, 'Brand#', '') as int)) as brand
        from (
          select p_type as schema_name, 'relation_' || cast(cast(floor(p_partkey / 8.0) as bigint) as string) as relation_name,
            case when p_size <= 10 then replace(p_name, ' ', '_') when p_size <= 20 then split_part(p_name, ' ', 2)
              when p_size <= 30 then split_part(p_name, ' ', 2) || '_id'
              when p_size <= 40 then split_part(p_name, ' ', 1) || '_name'
              else replace(p_name, ' ', '_') || '_id' end as column_name,
            p_size, p_brand
          from {part}) p
        group by schema_name, relation_name, column_name"""),
    "model": Derived(("part_column",), """
        select distinct node_key, case when schema_name = 'SMALL' then null else 'Rows of ' || relation_name end as description
        from {part_column} where schema_name <> 'PROMO'"""),
    "model_column": Derived(("part_column",), """
        select node_key, column_name, case when brand <= 16 then '' else 'Note on ' || column_name end as description
        from {part_column} where brand > 5 and schema_name <> 'PROMO'"""),
    "part_inventory": Derived(("part_column",), """
        select schema_name, relation_name, column_name,
          case when size <= 30 then 'varchar' when size <= 40 then 'decimal' else 'bigint' end as data_type,
          case when size <= 15 then 250 when size <= 30 then 10 else 0 end as char_length,
          case when size <= 30 then 0 when size <= 40 then 18 else 19 end as numeric_precision,
          case when size > 30 and size <= 40 then 2 else 0 end as numeric_scale
        from {part_column} where brand <> 3"""),
    "concept": Derived(("part",), """
        select distinct word as id, upper(word) as name, 'Concept of ' || word as description from (
          select split_part(p_name, ' ', 1) as word from {part} union all
          select split_part(p_name, ' ', 2) from {part} union all
          select replace(p_name, ' ', '_') from {part} where p_size < 6) w"""),
    "concept_implementation": Derived(("concept",), """
        select id as concept_id, id as column_name,
          case when id < 'h' then 'VARCHAR' when id < 's' then 'DECIMAL' else '' end as type_id,
          case when id < 'd' then 10 when id < 'h' then 250 else -1 end as max_length, 'table' as data_form
        from {concept}
        union all select id, 'xml_' || id, 'TEXT', -1, 'xml' from {concept}"""),
    "glossary": Derived(("concept",), """
        select id as column_name, id as name, case when id < 'c' then '' else description end as description,
          case when id < 'h' then 'VarChar' when id < 's' then 'decimal' else '' end as data_type,
          case when id < 'd' then 10 when id < 'h' then 250 else -1 end as max_length
        from {concept}
        union all select 'id', 'id', 'Unique id', 'bigint', -1 from (select count(*) as n from {concept}) c where n > 0"""),
    # Tests on the columns above: one per sale of the part a column is named after; a small sale's spans several columns.
    "column_test": Derived(("lineitem", "part"), """
        select 'warehouse' as database_name, p.p_type as schema_name,
          'relation_' || cast(cast(floor(p.p_partkey / 8.0) as bigint) as string) as relation_name,
          case when l.l_quantity < 49 then null when p.p_size <= 10 then replace(p.p_name, ' ', '_')
            when p.p_size <= 20 then split_part(p.p_name, ' ', 2)
            when p.p_size <= 30 then split_part(p.p_name, ' ', 2) || '_id'
            when p.p_size <= 40 then split_part(p.p_name, ' ', 1) || '_name'
            else replace(p.p_name, ' ', '_') || '_id' end as column_name
        from {lineitem} l join {part} p on p.p_partkey = l.l_partkey"""),
    # Runs of a model runner: the clicks and views of a day are the actions of its refresh run, the rest of its tests.
    "action": Derived(("events",), """
        select cast(cast(ts as date) as string) || '-' || case when event_type in ('click', 'view') then 'refresh' else 'test' end
            as invocation_id,
          'model.' || cast(event_id as string) as unique_id, value as execution_time_in_seconds,
          case when event_type in ('error', 'view') then 'error' else 'success' end as status, ts
        from {events}"""),
    "invocation": Derived(("action",), """
        select invocation_id as id, split_part(invocation_id, '-', 4) as operation,
          case when cast(min(ts) as date) in (date '2024-01-28', date '2024-01-30') then 'error' else 'success' end as status,
          case when cast(min(ts) as date) = date '2024-01-29' then 'tag:public' else 'tag:private' end as parameters,
          cast(sum(cast(round(execution_time_in_seconds * 100) as bigint)) as double) / 100 as execution_time_in_seconds,
          min(ts) as start_time
        from {action} group by invocation_id"""),
}


def frame(spark: SparkSession, sf_dir: str, name: str, known: dict[str, DataFrame] | None = None) -> DataFrame:
    """A supplied table or derived relation; ``known`` keeps the ones already resolved."""
    known = {} if known is None else known
    if name not in known:
        if name in TABLES:
            known[name] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        else:
            derived = DERIVED[name]
            known[name] = spark.sql(derived.sql, **{need: frame(spark, sf_dir, need, known) for need in derived.needs})
    return known[name]


def _ordered(names: tuple[str, ...]) -> list[str]:
    """Derived relations a query needs, each after the ones it reads."""
    found: list[str] = []

    def visit(name: str) -> None:
        if name in TABLES or name in found:
            return
        for need in DERIVED[name].needs:
            visit(need)
        found.append(name)

    for name in names:
        visit(name)
    return found


def with_inputs(sql: str, *names: str) -> str:
    """The SQL text behind the derived relations it reads, as common table expressions."""
    parts = []
    for name in _ordered(names):
        derived = DERIVED[name]
        parts.append(f"{name} as ({derived.sql.format(**{n: n for n in derived.needs})})")
    if not parts:
        return sql
    body = sql.strip()
    if body.lower().startswith("with "):
        return "with " + ",\n".join(parts) + ",\n" + body[5:]
    return "with " + ",\n".join(parts) + "\n" + body
