"""Inventories, run files, definition health and audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit, definitions, health, inventory
from ..sources import glossary, run_files, seed
from . import run_texts
from .inputs import TABLES
from ..session import new_shared_path
from .registry import Tables, query

# The supplied tables' columns: name, type, text length, precision.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
PRECISION = {"int": 10, "bigint": 19, "double": 53}


def _inventory_sql(table: str) -> str:
    rows = []
    for ordinal, column in enumerate(COLUMNS[table].split(", "), 1):
        name, kind = column.split(" ")
        is_text = kind == "string"
        longest = f"max(length({name}))" if is_text else "null"
        rows.append(
            f"select 'public' as schema_name, '{table}' as relation_name, '{name}' as column_name, {ordinal} as ordinal, "
            f"'{kind}' as data_type, {-1 if is_text else 0} as char_length, {PRECISION.get(kind, 0)} as numeric_precision, "
            f"0 as numeric_scale, false as is_view, count(*) as row_count, count({name}) as filled_rows, "
            f"cast({longest} as int) as longest_text from {table}"
        )
    return "\nunion all\n".join(rows)


INVENTORY_SQL = "\nunion all\n".join(_inventory_sql(name) for name in TABLES)


def _measured(t: Tables):
    return inventory.measured_inventory(t.spark, {("public", name): getattr(t, name) for name in TABLES})


@query("column_inventory", INVENTORY_SQL)
def _(t: Tables):
    return _measured(t)


@query("max_string_length", f"select * from ({INVENTORY_SQL}) i where char_length = -1")
def _(t: Tables):
    return inventory.unbounded_strings(_measured(t))


@query(
    "relation_cardinality_all",
    "\nunion all\n".join(
        f"select 'warehouse' as database_name, 'public' as schema_name, '{name}' as relation_name, count(*) as row_count from {name}"
        for name in TABLES
    )
    + "\nunion all select 'warehouse', 'public', 'not_there', -1",
)
def _(t: Tables):
    tables = {("warehouse", "public", name): getattr(t, name) for name in TABLES}
    tables["warehouse", "public", "not_there"] = inventory.readable(t.spark, f"{t.sf_dir}/not_there.parquet")
    return inventory.cardinality(t.spark, tables)


# Run files.

LOG_SQL = """
    select 'check_' || cast(l_partkey as varchar) as test_name,
      case when l_linenumber = 7 then 'test.gone.' else 'test.p.' end || cast(l_partkey as varchar) as unique_id,
      'checks/' || case when l_linenumber = 2 then '"}{' else '' end || cast(l_partkey as varchar) || '.sql' as sql_filename,
      case l_returnflag when 'A' then 'pass' when 'N' then 'warn' else 'fail' end as status,
      cast(l_quantity as bigint) as num_failures from lineitem"""
MANIFEST_SQL = """
    select 'test.p.' || cast(p_partkey as varchar) as unique_id, 'warehouse' as database_name,
      case when brand < 20 then p_type else 'UNKNOWN' end as schema_name,
      case when brand < 20 then p_name else 'UNKNOWN' end as relation_name,
      cast(p_partkey as varchar) || '.sql' as sql_filename, 'target/' || cast(p_partkey as varchar) || '.sql' as query_path,
      case when brand > 3 then 'select ''' || p_name || '''' else 'Not found!' end as sql
    from (select *, cast(replace(p_brand, 'Brand#', '') as int) as brand from part) p"""


@query("check_log_results", LOG_SQL)
def _(t: Tables):
    return run_files.check_log_results(run_texts.check_log(t))


@query(
    "check_log_corrupt",
    f"select '{run_texts.CUT_ENTRY}' as entry, count(*) as entry_count from lineitem where l_linenumber = 3 having count(*) > 0",
)
def _(t: Tables):
    return run_files.check_log_corrupt(run_texts.check_log(t))


@query("check_log_lines", LOG_SQL)
def _(t: Tables):
    """The same log as text files read by lines."""
    path = new_shared_path(t.spark, "check-log")
    # Packed to a tenth; a packed file is one file range, so its lines are bounded. No entry of these texts spans rows.
    packed = run_texts.check_log(t).write.option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", 100_000)
    packed.text(path, compression="gzip")
    return run_files.read_check_log(t.spark, path)[0]


@query(
    "check_log_header",
    """select l_linestatus as version, 'order ' || cast(l_orderkey as varchar) as executed_at,
         'run-' || cast(l_orderkey as varchar) as invocation_id from lineitem where l_linenumber = 1""",
)
def _(t: Tables):
    return run_files.check_log_header(run_texts.check_log(t))


@query("manifest_tests", MANIFEST_SQL)
def _(t: Tables):
    return run_files.parse_manifest_tests(run_texts.manifest(t))


@query(
    "manifest_test_targets",
    f"""with models as (
          select p_partkey // {run_texts.PARTS_PER_MANIFEST} as doc, p_name, arg_min(p_type, p_partkey) as schema_name
          from part group by 1, 2)
        select 'test.p.' || cast(p_partkey as varchar) as unique_id, 'warehouse' as database_name,
          case when p_size <= 30 then m.schema_name end as schema_name,
          case when p_size <= 30 then p.p_name when p_size <= 45 then 'p.' || cast(p_partkey as varchar) end as relation_name,
          p_brand as column_name
        from part p join models m on m.doc = p_partkey // {run_texts.PARTS_PER_MANIFEST} and m.p_name = p.p_name""",
)
def _(t: Tables):
    return run_files.parse_manifest_targets(run_texts.manifest(t))


@query(
    "catalog_columns",
    """select 'model.' || cast(s_suppkey as varchar) as node_key, 'warehouse' as database_name,
         'nation_' || cast(s_nationkey as varchar) as schema_name, 'supplier_' || cast(s_suppkey as varchar) as relation_name,
         c.column_key, c.column_name, c.ordinal
       from supplier, lateral (select 'id' as column_key, 'id' as column_name, 1 as ordinal
         union all select lower(s_name), s_name, 2) c""",
)
def _(t: Tables):
    return run_files.parse_catalog(run_texts.catalog(t))


@query(
    "glossary_csv",
    """select split_part(p_name, ' ', 2) as column_name, max_by(p_name, p_partkey) as name,
         max_by('Size ' || cast(p_size as varchar) || ', "' || p_brand || '"', p_partkey) as description,
         'varchar' as data_type, max_by(case when p_size > 10 then p_size else -1 end, p_partkey) as max_length
       from part where p_type <> 'PROMO' group by 1""",
)
def _(t: Tables):
    return glossary.parse_glossary_csv(run_texts.glossary_csv(t), "p_partkey")


@query(
    "glossary_json",
    """select split_part(p_name, ' ', 1) as column_name, split_part(p_name, ' ', 1) as name,
         max_by('Like ' || p_brand, p_partkey) as description, max_by(p_type, p_partkey) as data_type,
         max_by(case when p_size > 25 then p_size else -1 end, p_partkey) as max_length
       from part group by 1""",
)
def _(t: Tables):
    return glossary.parse_glossary_json(run_texts.glossary_json(t), "p_partkey")


SEED_COLUMNS = ("c_custkey", "c_name", "c_acctbal", "segment", "nationkey", "email", "phone", "national_id")


def _seed_value(column: str) -> str:
    return f"coalesce(cast({column} as varchar), '')"


@query(
    "seed_export_lines",
    f"""select '"' || {""" || '","' || """.join(_seed_value(c) for c in SEED_COLUMNS)} || '"' as line from customer_dirty
        union all select '{','.join(SEED_COLUMNS)}'""",
    ("customer_dirty",),
)
def _(t: Tables):
    header = t.spark.range(1).select(F.lit(seed.seed_header(t.customer_dirty)).alias("line"))
    return header.unionByName(seed.seed_lines(t.customer_dirty))


ATTRIBUTED_SQL = f"""
    with log as ({LOG_SQL}), tests as ({MANIFEST_SQL}),
    attributed as (select coalesce(database_name, 'UNKNOWN') as database_name, coalesce(schema_name, 'UNKNOWN') as schema_name,
      coalesce(relation_name, 'UNKNOWN') as relation_name, test_name, unique_id, status, num_failures,
      tests.sql_filename, query_path, coalesce(sql, 'Not found!') as sql from log left join tests using (unique_id))
"""


def _attributed(t: Tables):
    log = run_files.check_log_results(run_texts.check_log(t))
    return health.attribute_tests(log, run_files.parse_manifest_tests(run_texts.manifest(t)))


@query(
    "health_attributed",
    ATTRIBUTED_SQL + "select database_name, schema_name, relation_name, test_name, unique_id, status as result from attributed",
)
def _(t: Tables):
    return health.attributed_results(_attributed(t))


@query(
    "health_errors_from_log",
    ATTRIBUTED_SQL + """, sizes as (
      select 'warehouse' as database_name, p_type as schema_name, p_name as relation_name, count(*) as row_count
      from part where p_type <> 'PROMO' group by 1, 2, 3)
    select a.database_name, a.schema_name, a.relation_name, test_name, unique_id, sql_filename, num_failures as rows_on_error,
      round(num_failures * 100 / row_count, 4) as error_percentage, coalesce(row_count, -1) as rows_in_relation, query_path, sql
    from attributed a left join sizes s on s.database_name = a.database_name and s.schema_name = a.schema_name
      and s.relation_name = a.relation_name
    where status = 'fail'""",
)
def _(t: Tables):
    sizes = t.part.filter("p_type <> 'PROMO'").groupBy(
        F.lit("warehouse").alias("database_name"), F.col("p_type").alias("schema_name"), F.col("p_name").alias("relation_name")
    ).agg(F.count("*").alias("row_count"))
    return health.error_list(health.attributed_errors(_attributed(t), sizes))


# Definitions.

ENRICHED_INPUTS = ("part_column", "model", "model_column", "part_inventory", "glossary", "column_test")
ENRICHED_SQL = """
    with enriched as (
      select c.database_name, c.schema_name, c.relation_name, c.column_name,
        case when m.node_key is null then 'There is no model for this relation!' else coalesce(m.description, '') end as relation_description,
        case when k.node_key is null then 'This column is not in the model for this relation!' else k.description end as column_description,
        i.data_type as type_name, i.char_length as max_length, i.numeric_precision, i.numeric_scale,
        g.name as glossary_name, g.description as glossary_description, g.data_type as glossary_data_type,
        g.max_length as glossary_max_length
      from part_column c
      left join model m on m.node_key = c.node_key
      left join model_column k on k.node_key = c.node_key and k.column_name = c.column_name
      left join part_inventory i on i.schema_name = c.schema_name and i.relation_name = c.relation_name and i.column_name = c.column_name
      left join glossary g on g.column_name = case when c.column_name like '%\\_id' escape '\\' then 'id' else c.column_name end),
    tested as (select distinct schema_name, relation_name, column_name from column_test where column_name is not null),
    flagged as (
      select e.*, t.column_name is null as untested,
        column_description = '' and coalesce(glossary_description, '') = '' as undocumented,
        column_description <> '' and coalesce(glossary_description, '') <> '' and glossary_name <> 'id' as overwrites,
        case when coalesce(glossary_data_type, '') = '' then null
          when lower(glossary_data_type) <> coalesce(lower(type_name), 'UNKNOWN')
            then 'Gagnatýpa í skilgreiningu hugtaks: ' || lower(glossary_data_type) || ' - Gagnatýpa í grunni: ' || coalesce(lower(type_name), 'UNKNOWN')
          when lower(glossary_data_type) in ('char', 'nchar', 'varchar', 'nvarchar') and glossary_max_length is distinct from max_length
            then 'Lengd gagnatýpu í skilgreiningu hugtaks: ' || cast(glossary_max_length as varchar) || ' - Lengd í grunni: ' || cast(max_length as varchar)
          end as type_message
      from enriched e left join tested t on t.schema_name = e.schema_name and t.relation_name = e.relation_name and t.column_name = e.column_name)
"""
PUBLIC = ["STANDARD", "ECONOMY", "SMALL", "MEDIUM", "PROMO"]
PUBLIC_SQL = "schema_name in ('STANDARD', 'ECONOMY', 'SMALL', 'MEDIUM', 'PROMO')"


def _enriched(t: Tables):
    catalog = t.part_column.select("node_key", "database_name", "schema_name", "relation_name", "column_name")
    return definitions.enrich_catalog(catalog, t.model, t.model_column, t.part_inventory, t.glossary)


@query("enriched_catalog", ENRICHED_SQL + "select * from enriched", ENRICHED_INPUTS)
def _(t: Tables):
    return _enriched(t)


@query(
    "enriched_catalog_no_glossary",
    ENRICHED_SQL + "select schema_name, relation_name, column_name, '' as glossary_name, '' as glossary_description from enriched",
    ENRICHED_INPUTS,
)
def _(t: Tables):
    catalog = t.part_column.select("node_key", "database_name", "schema_name", "relation_name", "column_name")
    enriched = definitions.enrich_catalog(
        catalog, t.model, t.model_column, t.part_inventory, definitions.empty_glossary(catalog)
    )
    return enriched.select("schema_name", "relation_name", "column_name", "glossary_name", "glossary_description")


CONCEPTS_SQL = """
    select c.name as concept_name, c.description, i.column_name, i.type_id, i.max_length
    from concept_implementation i join concept c on c.id = i.concept_id where i.data_form = 'table'"""


def _concepts(t: Tables):
    return glossary.glossary_from_tables(t.concept, t.concept_implementation, "table")


@query("glossary_concepts", CONCEPTS_SQL, ("concept_implementation",))
def _(t: Tables):
    return _concepts(t)


@query(
    "glossary_best_match",
    f"""
    with concepts as ({CONCEPTS_SQL}),
    names as (select distinct column_name as n from part_inventory),
    candidates as (
      select 1 as match_type_id, * from names join concepts on n = column_name
      union all select 2, * from names join concepts on n = column_name || '_id'
      union all select 3, * from names join concepts on starts_with(n, column_name) and n <> column_name and length(column_name) > 2
      union all select 4, * from names join concepts on ends_with(n, column_name) and n <> column_name and length(column_name) > 2
      union all select 5, * from names join concepts on ends_with(n, column_name || '_id') and n <> column_name and length(column_name) > 2),
    ranked as (select *, row_number() over (partition by n order by match_type_id, length(column_name) desc, column_name, concept_name) as rn
      from candidates)
    select i.schema_name, i.relation_name, i.column_name, coalesce(concept_name, '') as concept_name,
      coalesce(description, '') as description, coalesce(lower(type_id), '') as data_type, coalesce(max_length, -1) as max_length,
      coalesce(match_type_id, 0) as match_type_id, coalesce(r.column_name, '') as matched_column_name
    from part_inventory i left join ranked r on r.n = i.column_name and rn = 1""",
    ("concept_implementation", "part_inventory"),
)
def _(t: Tables):
    return definitions.glossary_best_match(_concepts(t), t.part_inventory)


@query(
    "def_doc_errors",
    ENRICHED_SQL + "select schema_name, relation_name, column_name, 'Skjölun vantar!' as message from flagged where undocumented",
    ENRICHED_INPUTS,
)
def _(t: Tables):
    return definitions.documentation_errors(_enriched(t))


@query(
    "def_overwrites",
    ENRICHED_SQL + """select schema_name, relation_name, column_name, glossary_name as concept_name from flagged
      where overwrites and schema_name in ('STANDARD', 'MEDIUM')""",
    ENRICHED_INPUTS,
)
def _(t: Tables):
    return definitions.concept_overwrites(_enriched(t), ["STANDARD", "MEDIUM"])


@query(
    "def_type_errors",
    ENRICHED_SQL + "select schema_name, relation_name, column_name, type_message as message from flagged where type_message is not null",
    ENRICHED_INPUTS,
)
def _(t: Tables):
    return definitions.type_errors(_enriched(t))


@query(
    "def_test_coverage",
    """select database_name, schema_name, relation_name, column_name, count(*) as test_count from column_test
         where column_name is not null group by 1, 2, 3, 4
       union all
       select database_name, schema_name, relation_name, null, count(*) from column_test group by 1, 2, 3""",
    ("column_test",),
)
def _(t: Tables):
    by_relation = definitions.relation_test_coverage(t.column_test).withColumn("column_name", F.lit(None).cast("string"))
    return definitions.column_test_coverage(t.column_test).unionByName(by_relation)


@query(
    "def_coverage_errors",
    ENRICHED_SQL + """select schema_name, relation_name, column_name, 'Engar prófanir skilgreindar fyrir dálk!' as message
      from flagged where untested and schema_name in ('STANDARD', 'SMALL')""",
    ENRICHED_INPUTS,
)
def _(t: Tables):
    return definitions.test_coverage_errors(_enriched(t), t.column_test, ["STANDARD", "SMALL"])


def _share(kind: str) -> str:
    return f"{kind}_count, case when column_count = 0 then 0.0 else round({kind}_count * 100 / column_count, 2) end as {kind}_percentage"


@query(
    "def_stats",
    ENRICHED_SQL + f""", kinds as (
      select schema_name, relation_name, cast(overwrites as int) as o, cast(undocumented as int) as d,
        cast(type_message is not null as int) as y, cast(untested as int) as u
      from flagged where {PUBLIC_SQL}),
    sums as (
      select schema_name, relation_name, count(distinct schema_name || '.' || relation_name) as relation_count, count(*) as column_count,
        cast(coalesce(sum(o), 0) as bigint) as overwrite_count, cast(coalesce(sum(cast(d + y + u = 0 as int)), 0) as bigint) as ok_count,
        cast(coalesce(sum(d + y + u), 0) as bigint) as error_count, cast(coalesce(sum(y), 0) as bigint) as type_error_count,
        cast(coalesce(sum(d), 0) as bigint) as documentation_error_count, cast(coalesce(sum(u), 0) as bigint) as test_error_count
      from kinds group by grouping sets ((schema_name, relation_name), ()))
    select schema_name, relation_name, relation_count, column_count, {_share('overwrite')}, {_share('ok')}, {_share('error')},
      {_share('type_error')}, {_share('documentation_error')}, {_share('test_error')} from sums""",
    ENRICHED_INPUTS,
)
def _(t: Tables):
    return definitions.definition_stats(_enriched(t), t.column_test, PUBLIC)


@query(
    "doc_table",
    ENRICHED_SQL + f"""
    select schema_name, relation_name, column_name, relation_description, coalesce(type_name, 'UNKNOWN') as type_name,
      case when type_name is null then 'Metadata missing!' when type_name = 'varchar' then cast(max_length as varchar)
        else cast(numeric_precision - numeric_scale as varchar) || ', ' || cast(numeric_scale as varchar) end as type_length,
      coalesce(nullif(column_description, ''), nullif(glossary_description, '')) as description,
      case when column_description <> '' then 'Athugasemd við dálk' when glossary_description <> '' then 'Hugtök' end as origin,
      cast(undocumented as int) as missing
    from flagged where {PUBLIC_SQL}""",
    ENRICHED_INPUTS,
)
def _(t: Tables):
    return definitions.documentation_table(_enriched(t), PUBLIC)


# Definition health of the supplied tables themselves, with the types that Spark gives them.

REAL_GLOSSARY = (("doc_id", "bigint", -1), ("text", "varchar", 50), ("o_totalprice", "float", -1), ("c_nationkey", "varchar", 10),
                 ("id", "bigint", -1), ("lang", "int", -1), ("embedding", "varchar", 9))
REAL_SQL = f"""
    with inventory as ({INVENTORY_SQL}),
    glossary as (select * from (values {', '.join(f"('{n}', '{k}', {m})" for n, k, m in REAL_GLOSSARY)}) g(name, wanted, wanted_length)),
    joined as (
      select i.*, g.name as concept, wanted, wanted_length from inventory i
      left join glossary g on g.name = case when i.column_name like '%\\_id' escape '\\' then 'id' else i.column_name end)
"""


def _real_enriched(t: Tables):
    inventory_ = _measured(t)
    rows = [(n, n, f"Concept of {n}", k, m) for n, k, m in REAL_GLOSSARY]
    concepts = t.spark.createDataFrame(rows, "column_name string, name string, description string, data_type string, max_length int")
    places = inventory_.select(
        F.concat_ws(".", F.lit("model"), "schema_name", "relation_name").alias("node_key"),
        F.lit("warehouse").alias("database_name"), "schema_name", "relation_name", "column_name",
    )
    models = places.select("node_key", F.lit("").alias("description")).distinct()
    columns = places.select("node_key", "column_name", F.lit("").alias("description"))
    return definitions.enrich_catalog(places, models, columns, inventory_, concepts)


@query(
    "def_type_errors_spark",
    REAL_SQL + """select schema_name, relation_name, column_name,
        'Gagnatýpa í skilgreiningu hugtaks: ' || wanted || ' - Gagnatýpa í grunni: ' || data_type as message
      from joined where wanted is not null and wanted <> data_type
        and not (data_type = 'string' and wanted = 'varchar') and not (data_type = 'double' and wanted = 'float')""",
)
def _(t: Tables):
    return definitions.type_errors(_real_enriched(t))


@query(
    "doc_table_spark",
    REAL_SQL + """select schema_name, relation_name, column_name, '' as relation_description, data_type as type_name,
        case when data_type = 'string' then cast(char_length as varchar)
          when data_type in ('int', 'bigint', 'double') then cast(numeric_precision as varchar) || ', 0' else '' end as type_length,
        'Concept of ' || concept as description, case when concept is not null then 'Hugtök' end as origin,
        cast(concept is null as int) as missing
      from joined""",
)
def _(t: Tables):
    return definitions.documentation_table(_real_enriched(t), ["public"])


# Audit.


@query(
    "audit_invocations",
    """select 'run-' || cast(o_orderkey as varchar) as id, 'parent-' || cast(o_custkey as varchar) as parent_run_id,
         'refresh' as operation, o_orderstatus as status, o_totalprice as execution_time_in_seconds,
         o_orderpriority as parameters, '1.4' as version, o_orderdate as start_time from orders""",
)
def _(t: Tables):
    return audit.audit_invocations(run_texts.run_results(t))


@query(
    "audit_actions",
    """select 'run-' || cast(o_orderkey as varchar) as invocation_id, 'model.customer_' || cast(o_custkey as varchar) as unique_id,
         'warehouse.sales.' || c_name as relation_name, 'success' as status, o_totalprice as execution_time_in_seconds,
         o_custkey as rows_affected, 'Thread-1' as thread_id
       from orders join customer on c_custkey = o_custkey
       union all
       select 'run-' || cast(o_orderkey as varchar), 'model.unknown_' || cast(o_orderkey as varchar), '', o_orderstatus, 0.5, 0, 'Thread-2'
       from orders""",
)
def _(t: Tables):
    return audit.audit_actions(run_texts.run_results(t), run_files.manifest_nodes(run_texts.customer_manifest(t)))


@query(
    "top_expensive",
    """with latest as (
         select id, execution_time_in_seconds as total from invocation
         where status = 'success' and operation = 'refresh' and parameters like '%tag:private%' order by start_time desc, id desc limit 1)
       select unique_id, round(a.execution_time_in_seconds, 0) as seconds,
         round(a.execution_time_in_seconds * 100 / total, 0) as percentage_of_run_time, status
       from action a join latest on id = invocation_id order by a.execution_time_in_seconds desc, unique_id limit 10""",
    ("invocation", "action"),
)
def _(t: Tables):
    return audit.top_expensive_actions(t.invocation, t.action, "refresh", "%tag:private%")


@query(
    "run_time_trend",
    """select operation, round(avg(execution_time_in_seconds), 0) as seconds, cast(start_time as date) as day
       from invocation where status = 'success' and cast(start_time as date) >= timestamp '2024-01-30 12:00:00' - interval 7 day
       group by operation, cast(start_time as date)""",
    ("invocation",),
)
def _(t: Tables):
    return audit.run_time_trend(t.invocation, F.to_timestamp_ntz(F.lit("2024-01-30 12:00:00")))
