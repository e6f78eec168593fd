"""Run files as JSON and CSV texts, built by Spark from the supplied tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .registry import Tables


def _text(*parts: Column | str) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


CUT_ENTRY = '{"info": {"name": "LogTestResult", "ts'


def check_log(t: Tables) -> DataFrame:
    """Two or three entries per text: a test result of every line item, a version or start entry, and a cut entry
    after third lines. Names hold braces, and some texts break lines between or inside entries."""
    key = F.col("l_partkey").cast("string")
    result = F.struct(
        F.struct(F.lit("LogTestResult").alias("name"), F.lit("2024-01-01T00:00:00").alias("ts"), F.lit("run-1").alias("invocation_id")).alias("info"),
        F.struct(
            F.struct(
                _text("check_", key).alias("node_name"),
                F.when(F.col("l_linenumber") == 7, _text("test.gone.", key)).otherwise(_text("test.p.", key)).alias("unique_id"),
                _text("checks/", F.when(F.col("l_linenumber") == 2, '"}{').otherwise(""), key, ".sql").alias("node_path"),
            ).alias("node_info"),
            F.when(F.col("l_returnflag") == "A", "pass").when(F.col("l_returnflag") == "N", "warn").otherwise("fail").alias("status"),
            F.col("l_quantity").cast("bigint").alias("num_failures"),
        ).alias("data"),
    )
    other = F.struct(
        F.struct(
            F.when(F.col("l_linenumber") == 1, "MainReportVersion").otherwise("LogStartLine").alias("name"),
            _text("order ", F.col("l_orderkey").cast("string")).alias("ts"),
            _text("run-", F.col("l_orderkey").cast("string")).alias("invocation_id"),
        ).alias("info"),
        F.struct(_text("=", F.col("l_linestatus")).alias("version")).alias("data"),
    )
    between = F.when(F.col("l_linenumber") == 4, "\r\n").otherwise("")
    spread = F.when(F.col("l_linenumber") == 5, F.replace(F.to_json(result), F.lit('"data":'), F.lit('\n  "data":\n')))
    cut = F.when(F.col("l_linenumber") == 3, CUT_ENTRY).otherwise("")
    # A small file is one scan task; building and parsing texts is dear enough to be dealt out.
    items = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_linestatus", "l_returnflag", "l_quantity")
    return items.repartition(t.spark.sparkContext.defaultParallelism).select(
        F.concat(F.coalesce(spread, F.to_json(result)), between, F.to_json(other), cut).alias("value")
    )


PARTS_PER_MANIFEST = 50


def manifest(t: Tables) -> DataFrame:
    """Manifests of fifty parts: a model per part, and a test on it that sometimes has no text or no known parent, and
    one, two or no references."""
    key = F.col("p_partkey").cast("string")
    brand = F.regexp_replace("p_brand", "Brand#", "").cast("int")
    model_key, test_key = _text("model.p.part_", key), _text("test.p.", key)
    nothing = F.lit(None).cast("string")
    no_refs = F.array().cast("array<struct<name:string>>")

    def ref(name: Column) -> Column:
        return F.struct(name.alias("name"))

    model = F.struct(
        F.lit("model").alias("resource_type"), model_key.alias("unique_id"), F.lit("warehouse").alias("database"),
        F.col("p_type").alias("schema"), F.col("p_name").alias("name"), nothing.alias("path"), nothing.alias("compiled_path"),
        nothing.alias("compiled_code"), nothing.alias("file_key_name"),
        F.struct(F.array().cast("array<string>").alias("nodes")).alias("depends_on"),
        no_refs.alias("refs"), nothing.alias("column_name"),
    )
    test = F.struct(
        F.lit("test").alias("resource_type"), test_key.alias("unique_id"), F.lit("warehouse").alias("database"),
        F.lit("tests").alias("schema"), _text("check_", key).alias("name"), _text(key, ".sql").alias("path"),
        _text("target/", key, ".sql").alias("compiled_path"),
        F.when(brand > 3, _text("select '", F.col("p_name"), "'")).alias("compiled_code"),
        F.when(brand < 20, _text("models.part_", key)).otherwise("models.other").alias("file_key_name"),
        F.struct(F.array(_text("model.p.missing_part_", key), model_key).alias("nodes")).alias("depends_on"),
        F.when(F.col("p_size") <= 30, F.array(ref(F.col("p_name"))))
        .when(F.col("p_size") <= 45, F.array(ref(F.col("p_name")), ref(_text("p.", key)))).otherwise(no_refs).alias("refs"),
        F.col("p_brand").alias("column_name"),
    )
    entry = F.array(F.struct(model_key.alias("key"), model.alias("value")), F.struct(test_key.alias("key"), test.alias("value")))
    listed = t.part.select(F.expr(f"p_partkey div {PARTS_PER_MANIFEST}").alias("doc"), "p_partkey", entry.alias("entries"))
    grouped = listed.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("p_partkey", "entries"))).alias("all"))
    nodes = F.map_from_entries(F.flatten(F.transform("all", lambda e: e["entries"])))
    return grouped.select(F.to_json(F.struct(nodes.alias("nodes"))).alias("value"))


def catalog(t: Tables) -> DataFrame:
    """One catalog per supplier: its relation with two columns."""
    key = F.col("s_suppkey").cast("string")
    columns = F.map_from_arrays(
        F.array(F.lit("id"), F.lower("s_name")),
        F.array(F.struct(F.lit("id").alias("name"), F.lit(1).alias("index")), F.struct(F.col("s_name").alias("name"), F.lit(2).alias("index"))),
    )
    node = F.struct(
        F.struct(
            F.lit("warehouse").alias("database"), _text("nation_", F.col("s_nationkey").cast("string")).alias("schema"),
            _text("supplier_", key).alias("name"),
        ).alias("metadata"),
        columns.alias("columns"),
    )
    return t.supplier.select(
        F.to_json(F.struct(F.map_from_arrays(F.array(_text("model.", key)), F.array(node)).alias("nodes"))).alias("value")
    )


def glossary_csv(t: Tables) -> DataFrame:
    """A CSV line per part, header lines for promotional ones; names repeat, so later lines win."""
    size = F.col("p_size").cast("string")
    length = F.when(F.col("p_size") > 10, size).otherwise("")
    line = _text(F.split_part("p_name", F.lit(" "), F.lit(2)), ",", F.col("p_name"), ',"Size ', size, ', ""', F.col("p_brand"), '""",varchar,', length)
    header = F.lit("column_name,name,description,data_type,max_length")
    return t.part.select("p_partkey", F.when(F.col("p_type") == "PROMO", header).otherwise(line).alias("value"))


def glossary_json(t: Tables) -> DataFrame:
    entry = F.struct(
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("column_name"),
        _text("Like ", F.col("p_brand")).alias("description"),
        F.col("p_type").alias("data_type"),
        F.when(F.col("p_size") > 25, F.col("p_size").cast("string")).alias("max_length"),
    )
    return t.part.select("p_partkey", F.to_json(entry).alias("value"))


def run_results(t: Tables) -> DataFrame:
    """One run-result document per order with two actions, the second of an unknown model."""
    key, customer = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    known = F.struct(
        _text("model.customer_", customer).alias("unique_id"), F.lit("success").alias("status"),
        F.col("o_totalprice").alias("execution_time"), F.lit("Thread-1").alias("thread_id"),
        F.struct(F.col("o_custkey").alias("rows_affected")).alias("adapter_response"),
    )
    unknown = F.struct(
        _text("model.unknown_", key).alias("unique_id"), F.col("o_orderstatus").alias("status"),
        F.lit(0.5).alias("execution_time"), F.lit("Thread-2").alias("thread_id"),
        F.lit(None).cast("struct<rows_affected: bigint>").alias("adapter_response"),
    )
    document = F.struct(
        F.struct(F.lit("1.4").alias("dbt_version"), _text("run-", key).alias("invocation_id")).alias("metadata"),
        F.col("o_totalprice").alias("elapsed_time"), F.col("o_orderpriority").alias("args"), F.array(known, unknown).alias("results"),
    )
    return t.orders.select(
        F.to_json(document).alias("value"), _text("parent-", customer).alias("parent_run_id"), F.lit("refresh").alias("operation"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("start_time"),
    )


def customer_manifest(t: Tables) -> DataFrame:
    key = _text("model.customer_", F.col("c_custkey").cast("string"))
    node = F.struct(key.alias("unique_id"), _text('"warehouse"."sales"."', F.col("c_name"), '"').alias("relation_name"))
    return t.customer.select(F.to_json(F.struct(F.map_from_arrays(F.array(key), F.array(node)).alias("nodes"))).alias("value"))
