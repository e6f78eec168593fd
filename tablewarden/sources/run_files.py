"""Check logs, manifests, catalogs and run results written as JSON by a model runner.

Every reader is a parser over a DataFrame of JSON texts, so many files, or texts already in a table, are parsed
by the executors in one job.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.common import own_shuffle
from .storage import settled

# Entry names and texts of the run files.
TEST_RESULT_ENTRY = "LogTestResult"
VERSION_ENTRY = "MainReportVersion"
MISSING_SQL = "Not found!"
UNKNOWN = "UNKNOWN"

CORRUPT = "_corrupt_record"
# A log entry read sign by sign: strings, other text, and closing braces that no opening one follows, up to one that is followed. All
# repetitions are possessive, so a text is read once from left to right.
LOG_ENTRY = r'(?:"(?:[^"\\]++|\\.)*+(?:"|\z)|[^"}]++|\}(?!\s*\{))++(?:\}(?=\s*\{))?|\}'
STRING = r'"(?:[^"\\]++|\\.)*+"'
LOG_SCHEMA = """
    info struct<name: string, ts: string, invocation_id: string>,
    data struct<
        node_info: struct<node_name: string, unique_id: string, node_path: string>,
        status: string, num_failures: bigint, version: string>
"""
MANIFEST_SCHEMA = """
    nodes map<string, struct<
        resource_type: string, unique_id: string, database: string, `schema`: string, name: string, path: string,
        compiled_path: string, compiled_code: string, file_key_name: string, relation_name: string,
        description: string, column_name: string,
        depends_on: struct<nodes: array<string>>,
        refs: array<struct<name: string>>,
        columns: map<string, struct<name: string, description: string>>>>
"""
CATALOG_SCHEMA = """
    nodes map<string, struct<
        metadata: struct<database: string, `schema`: string, name: string>,
        columns: map<string, struct<name: string, index: int>>>>
"""
RUN_RESULTS_SCHEMA = """
    metadata struct<dbt_version: string, invocation_id: string>,
    elapsed_time double,
    args string,
    results array<struct<
        unique_id: string, status: string, execution_time: double, thread_id: string,
        adapter_response: struct<rows_affected: bigint>>>
"""


def read_texts(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Files as a ``value`` column, a row per line or per file (one JSON document may span lines)."""
    return spark.read.text(path, wholetext=whole_files)


def _parsed(texts: DataFrame, schema: str, *keep: str) -> DataFrame:
    """The fields of the JSON texts as columns.

    As the only element of an inlined array a text is parsed once; as a struct column it would be parsed again for
    every field that is used.
    """
    return texts.select(*keep, F.inline(F.array(F.from_json("value", schema))))


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of the logs below a path, each with its file (``log``), file range (``block``) and place (``at``)."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("log"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value",
    )


def _in_string(text: Column) -> Column:
    """Whether a text that starts outside of strings ends in one. Escaped quotes count inside strings only."""
    odd = (F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))) % 2 == 1
    unclosed = F.contains(F.regexp_replace(text, STRING, ""), F.lit('"'))
    return F.when(F.contains(text, F.lit("\\")), unclosed).otherwise(odd)


def _divided(logs: DataFrame, *keep: str) -> DataFrame:
    """The entries of each text in order, as ``part`` and ``text``.

    A text is cut behind every brace that an opening one follows. Only if one of these cuts lies in a string, which leaves
    an odd number of quotes before it, is it read sign by sign.
    """
    text, cuts = F.col("value"), F.col("cuts")
    pieces = F.transform(cuts, lambda piece, i: F.when(i < F.size(cuts) - 1, F.concat(piece, F.lit("}"))).otherwise(piece))
    in_string = F.exists(F.slice(cuts, 1, F.greatest(F.size(cuts) - 1, F.lit(0))), _in_string)
    exact = F.regexp_extract_all(text, F.lit(LOG_ENTRY), F.lit(0))
    parts = F.when(F.size(cuts) < 2, F.array(text)).when(in_string, exact).otherwise(pieces)
    cut = logs.select(*keep, "value", F.split("value", r"\}(?=\s*\{)").alias("cuts"))
    return cut.select(*keep, F.posexplode(parts).alias("part", "text")).filter(_filled(F.col("text")))


def _filled(text: Column) -> Column:
    return F.trim(F.translate(text, "\r\n\t", "   ")) != ""


def log_entries(logs: DataFrame) -> DataFrame:
    """The entries of logs of concatenated JSON objects, one per row as ``value``.

    ``logs`` are whole logs as texts (``value``), or lines as :func:`read_log_lines` gives them, which are stitched. Braces
    inside strings divide nothing. A broken entry stays a row of its own where the next one begins behind a brace.
    """
    if {"log", "block", "at"} <= set(logs.columns):
        return stitched_entries(logs)
    return _divided(logs).select(F.col("text").alias("value"))


def _with_borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with ``border``, whether they surely begin an entry, and ``lone``, whether the next line of their range surely
    does, too. A border is sure behind a closing brace if the line opens one, and behind an odd number of quotes without
    escapes. Only a line that is the next of its range after the one before is judged, so any order of rows is right."""
    held, before = None, (None, None, None, False, False)
    for batch in batches:
        if not batch.num_rows:
            continue
        log, block, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
        text = batch.column(3)
        bare = pc.ascii_trim(text, " \r\n\t")

        def known(flags: pa.Array) -> np.ndarray:
            return pc.fill_null(flags, False).to_numpy(zero_copy_only=False)

        opens, ends = known(pc.starts_with(bare, "{")), known(pc.ends_with(bare, "}"))
        odd = pc.equal(pc.bit_wise_and(pc.count_substring(text, '"'), 1), 1)
        broken = known(pc.and_(odd, pc.invert(pc.match_substring(text, "\\"))))
        border = np.zeros(len(at), bool)
        near = (log[1:] == log[:-1]) & (block[1:] == block[:-1]) & (at[1:] == at[:-1] + 1)
        border[1:] = near & (opens[1:] & ends[:-1] | broken[:-1])
        if held is not None and (log[0], block[0], at[0] - 1) == before[:3]:
            border[0] = opens[0] and before[3] or before[4]
        if held is not None:
            yield _marked_lines(*held, np.array([held[1][0] and border[0]]))
        yield _marked_lines(batch.slice(0, len(at) - 1), border[:-1], border[:-1] & border[1:])
        held, before = (batch.slice(len(at) - 1), border[-1:]), (log[-1], block[-1], at[-1], ends[-1], broken[-1])
    if held is not None:
        yield _marked_lines(*held, np.zeros(1, bool))


def _marked_lines(lines: pa.RecordBatch, border: np.ndarray, lone: np.ndarray) -> pa.RecordBatch:
    names = ["log", "block", "at", "value", "border", "lone"]
    return pa.RecordBatch.from_arrays([*lines.columns, pa.array(border), pa.array(lone)], names=names)


def stitched_entries(lines: DataFrame) -> DataFrame:
    """The entries of logs given as lines (``log``, ``block``, ``at``, ``value``).

    A line between two sure borders holds whole entries and is divided where it is read. Only the others, which hold a part of
    an entry or stand at the ends of a range, are written and shuffled. Without the lines between them they keep their
    borders, which they bring along, and each range its first and last line.
    """
    named = lines.select(
        F.xxhash64("log").alias("log"), F.col("block").cast("bigint").alias("block"), F.col("at").cast("bigint").alias("at"), "value"
    )
    marked = named.mapInArrow(_with_borders, "log bigint, block bigint, at bigint, value string, border boolean, lone boolean")
    open_lines = settled(marked.filter(~F.col("lone")).drop("lone"), "log-lines")
    whole = _divided(marked.filter("lone")).select(F.col("text").alias("value"))
    return whole.union(_sewn_entries(open_lines))


def _sewn_entries(lines: DataFrame) -> DataFrame:
    """The entries of lines that may hold parts of entries; ``border`` tells where one begins for sure.

    Lines are read twice and shuffled once with their texts, by file range; no row or window holds more than a range. An entry begins behind the
    closing brace of another if it opens one, behind an entry whose braces are all closed, and behind a line that ends in
    a string, which is broken because strings hold no line breaks. Otherwise it goes on with the next line.

    The number of open braces runs along the lines, never below zero. From ``c`` open braces a range goes to
    ``max(c + total, total - lowest)``, with the sum of its steps and their lowest partial sum, so one row per range tells
    the next range what is open. Entries that end in a later range take their lines from there.
    """
    in_block = Window.partitionBy("log", "block").orderBy("at", "part")
    parts = _divided(lines, "log", "block", "at", "border")
    # Strings may hold braces. Without escapes only quotes and braces need to be looked at.
    text = F.col("text")
    signs = F.regexp_replace(F.regexp_replace(text, r'[^"{}]+', ""), r'"[{}]*(?:"|\z)', "")
    exact = F.regexp_replace(F.regexp_replace(text, STRING, ""), r'(?s)".*', "")
    read = parts.select(
        "*", F.when(F.contains(text, F.lit("\\")), exact).otherwise(signs).alias("bare"), _in_string(text).alias("broken"),
        F.trim(F.translate(text, "\r\n\t", "   ")).alias("trimmed"),
    )

    def count(sign: str) -> Column:
        return F.length("bare") - F.length(F.replace(F.col("bare"), F.lit(sign), F.lit("")))

    marked = read.select(
        "log", "block", "at", "part", "text", "border", (count("{") - count("}")).alias("step"), "broken",
        F.startswith("trimmed", F.lit("{")).alias("opens"),
        (F.endswith("trimmed", F.lit("}")) & ~F.col("broken")).alias("closes"),
    )
    behind = F.lag(F.struct("closes", "broken")).over(in_block)
    divides = F.col("border") | (F.col("part") > 0) | (F.col("opens") & behind["closes"]) | behind["broken"]
    cut = marked.withColumn("divided", F.coalesce(divides, F.lit(False)))
    cut = cut.withColumn("stretch", F.sum(F.col("divided").cast("int")).over(in_block))
    in_stretch = Window.partitionBy("log", "block", "stretch").orderBy("at", "part")
    summed = cut.withColumn("sum", F.sum("step").over(in_stretch)).withColumn("low", F.min("sum").over(in_stretch))

    # One row per file range: what its first line follows, and how many braces are open there.
    place = F.struct("at", "part")
    ranges = summed.groupBy("log", "block").agg(
        F.min_by("opens", place).alias("opens"), F.max_by("closes", place).alias("closes"),
        F.max_by("broken", place).alias("broken"), F.max("stretch").alias("stretches"),
        F.max_by(F.struct("sum", "low"), place).alias("last"),
    )
    by_log = Window.partitionBy("log").orderBy("block")
    earlier = F.lag(F.struct("closes", "broken")).over(by_log)
    fresh = earlier.isNull() | F.col("opens") & earlier["closes"] | earlier["broken"]
    ranges = ranges.withColumn("fresh", fresh)
    # Behind a border the open braces do not depend on those before the range.
    ranges = ranges.withColumn("borders", F.sum((F.col("fresh") | (F.col("stretches") > 0)).cast("int")).over(by_log))
    since_border = Window.partitionBy("log", "borders").orderBy("block")
    border = F.row_number().over(since_border) == 1
    ranges = ranges.withColumn("total", F.when(border, 0).otherwise(F.col("last.sum"))).withColumn(
        "least", F.when(border, F.greatest(F.col("last.sum"), F.col("last.sum") - F.col("last.low"))).otherwise(F.col("last.sum") - F.col("last.low"))
    )
    ranges = ranges.withColumn("totals", F.sum("total").over(since_border))
    ranges = ranges.withColumn("left_open", F.col("totals") + F.max(F.col("least") - F.col("totals")).over(since_border))
    carried = settled(ranges.select(
        "log", "block", "fresh", F.when(F.col("fresh"), 0).otherwise(F.lag("left_open").over(by_log)).alias("carried")
    ), "log-ranges")

    known = summed.join(carried, ["log", "block"])
    start = F.when(F.col("stretch") == 0, F.col("carried")).otherwise(0)
    known = known.withColumn("open", F.greatest(start + F.col("sum"), F.col("sum") - F.col("low")))
    first = F.lag("open").over(in_block).isNull()
    begins = F.col("divided") | F.when(first, F.col("fresh") | (F.col("carried") == 0)).otherwise(F.lag("open").over(in_block) == 0)
    numbered = known.withColumn("entry", F.sum(begins.cast("int")).over(in_block))
    # Ranges are dealt out already, so their entries come together where they are.
    pieces = settled(numbered.groupBy("log", "block", "entry").agg(
        F.sort_array(F.collect_list(F.struct("at", "part", "text"))).alias("lines")
    ).select("log", "block", "entry", F.array_join("lines.text", "\n").alias("value")), "log-pieces")
    held = pieces.groupBy("log", "block").agg(F.max("entry").alias("entries"), F.min("entry").alias("least"))
    later = F.lead("least").over(by_log) == 0
    owner = F.last(F.when(F.col("entries") > 0, F.struct("block", "entries")), ignorenulls=True).over(
        by_log.rowsBetween(Window.unboundedPreceding, -1)
    )
    seams = held.select("log", "block", "entries", F.coalesce(later, F.lit(False)).alias("goes_on"), owner.alias("owner"))
    sewn = pieces.join(seams, ["log", "block"])
    loose = (F.col("entry") == 0) | (F.col("entry") == F.col("entries")) & F.col("goes_on")
    own = F.struct("block", F.col("entry").alias("entries"))
    joined = sewn.filter(loose).groupBy("log", F.when(F.col("entry") == 0, F.col("owner")).otherwise(own).alias("owner")).agg(
        F.sort_array(F.collect_list(F.struct("block", "value"))).alias("pieces")  # a piece of each range it spans
    ).select(F.array_join("pieces.value", "\n").alias("value"))
    return sewn.filter(~loose).select("value").union(joined)


def _parsed_entries(entries: DataFrame) -> DataFrame:
    schema = f"{LOG_SCHEMA}, {CORRUPT} string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return entries.select("value", F.inline(F.array(F.from_json("value", schema, options))))


def parse_check_log(logs: DataFrame, entry_name: str | None = None, divided: bool = False) -> DataFrame:
    """Readable log entries. :func:`check_log_corrupt` has the others. With ``divided`` the rows are entries already.

    With ``entry_name`` only entries of that name: a text search drops most others before anything is parsed, and
    each remaining entry is parsed once.
    """
    entries = logs if divided else log_entries(logs)
    if entry_name is not None:
        entries = entries.filter(F.col("value").contains(entry_name))
    read = _parsed_entries(entries).filter(F.col(CORRUPT).isNull()).drop("value", CORRUPT)
    return read if entry_name is None else read.filter(F.col("info.name") == entry_name)


def check_log_corrupt(texts: DataFrame) -> DataFrame:
    """Entries that could not be read, and how often each text occurs: no log is reported without its gaps."""
    broken = _parsed_entries(log_entries(texts)).filter(F.col(CORRUPT).isNotNull())
    return broken.groupBy(F.col("value").alias("entry")).agg(F.count("*").alias("entry_count"))


def check_log_results(logs: DataFrame, divided: bool = False) -> DataFrame:
    """The check outcomes in a log."""
    return parse_check_log(logs, TEST_RESULT_ENTRY, divided).select(
        F.col("data.node_info.node_name").alias("test_name"),
        F.col("data.node_info.unique_id").alias("unique_id"),
        F.col("data.node_info.node_path").alias("sql_filename"),
        F.col("data.status").alias("status"),
        F.col("data.num_failures").alias("num_failures"),
    )


def check_log_header(logs: DataFrame, divided: bool = False) -> DataFrame:
    """Report header: runner version, time and id of the run."""
    return parse_check_log(logs, VERSION_ENTRY, divided).select(
        F.replace(F.col("data.version"), F.lit("="), F.lit("")).alias("version"),
        F.col("info.ts").alias("executed_at"),
        F.col("info.invocation_id").alias("invocation_id"),
    )


def manifest_nodes(texts: DataFrame) -> DataFrame:
    """One row per manifest node: its place and key in the manifest and its fields. ``doc`` tells the manifests apart;
    it is a digest of the text unless the texts have it."""
    if "doc" not in texts.columns:
        texts = texts.withColumn("doc", F.xxhash64("value"))
    return _parsed(texts, MANIFEST_SCHEMA, "doc").select("doc", F.posexplode("nodes").alias("place", "node_key", "node"))


def parse_manifest_tests(texts: DataFrame) -> DataFrame:
    """Test nodes with the schema and relation of their parent.

    The parent is the first dependency that is a node of the same manifest and whose key contains the model name,
    which is what follows the first dot of ``file_key_name``. Nodes are rows, and dependencies meet nodes in a join
    on manifest and key, so a manifest of many nodes is spread over tasks.
    """
    nodes = manifest_nodes(texts)
    tests = nodes.filter(F.col("node.resource_type") == "test")
    parents = nodes.groupBy("doc", F.col("node_key").alias("dependency"), own_shuffle("doc", "node_key")).agg(
        F.min(F.struct("node.schema", "node.name")).alias("parent")
    ).drop("_spread")
    file_key = F.col("node.file_key_name")
    dot = F.instr(file_key, ".")
    model = F.when(dot > 0, F.substr(file_key, dot + 1)).otherwise(F.lit(""))
    wanted = tests.select(
        "doc", "node_key", model.alias("model"), F.posexplode("node.depends_on.nodes").alias("rank", "dependency")
    ).filter(F.col("dependency").contains(F.col("model")))
    found = (
        wanted.join(parents, ["doc", "dependency"])
        .groupBy("doc", "node_key", own_shuffle("doc", "node_key"))
        .agg(F.min_by("parent", "rank").alias("parent")).drop("_spread")
    )
    keep = ["doc"] if "doc" in texts.columns else []
    return tests.join(found, ["doc", "node_key"], "left").select(
        *keep,
        F.col("node.unique_id").alias("unique_id"),
        F.col("node.database").alias("database_name"),
        F.coalesce("parent.schema", F.lit(UNKNOWN)).alias("schema_name"),
        F.coalesce("parent.name", F.lit(UNKNOWN)).alias("relation_name"),
        F.col("node.path").alias("sql_filename"),
        F.col("node.compiled_path").alias("query_path"),
        F.coalesce("node.compiled_code", F.lit(MISSING_SQL)).alias("sql"),
    )


def parse_catalog(texts: DataFrame) -> DataFrame:
    """One row per relation and column of the catalogs."""
    relations = _parsed(texts, CATALOG_SCHEMA).select(F.explode("nodes").alias("node_key", "node"))
    return relations.select("node_key", "node.metadata", F.explode("node.columns").alias("column_key", "column")).select(
        "node_key",
        F.col("metadata.database").alias("database_name"),
        F.col("metadata.schema").alias("schema_name"),
        F.col("metadata.name").alias("relation_name"),
        "column_key",
        F.col("column.name").alias("column_name"),
        F.col("column.index").alias("ordinal"),
    )


def parse_run_results(texts: DataFrame) -> DataFrame:
    """Run-result documents; columns other than ``value`` (run id, operation, status, start) are kept."""
    keep = [c for c in texts.columns if c != "value"]
    return _parsed(texts, RUN_RESULTS_SCHEMA, *keep)


def parse_manifest_targets(texts: DataFrame) -> DataFrame:
    """Test nodes with the relation and column they are about.

    The relation is a single reference, or the reference whose name comes first in the test's id; its schema is
    that of the model node of that name in the same manifest. A test without references has neither.
    """
    nodes = manifest_nodes(texts)
    refs, unique_id = F.col("node.refs"), F.col("node.unique_id")
    named = F.transform(refs, lambda r: F.struct(F.instr(unique_id, r["name"]).alias("at"), r["name"].alias("name")))
    found = F.sort_array(F.filter(named, lambda r: r["at"] > 0))
    relation = F.when(F.size(refs) == 1, F.try_element_at(refs, F.lit(1))["name"]).otherwise(
        F.try_element_at(found, F.lit(1))["name"]
    )
    tests = nodes.filter(F.col("node.resource_type") == "test").select("doc", "node", relation.alias("relation_name"))
    models = (
        nodes.filter(F.col("node.resource_type") != "test")
        .groupBy("doc", F.col("node.name").alias("relation_name"), own_shuffle("doc", "node.name"))
        .agg(F.min_by("node.schema", "place").alias("schema_name")).drop("_spread")
    )
    return tests.join(models, ["doc", "relation_name"], "left").select(
        F.col("node.unique_id").alias("unique_id"), F.col("node.database").alias("database_name"),
        "schema_name", "relation_name", F.col("node.column_name").alias("column_name"),
    )


# Readers of files. A log is read by lines; every other run file is one document.


def read_check_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Outcomes and headers of the check logs below a path, of any size. Entries may span lines."""
    entries = log_entries(read_log_lines(spark, path))
    return check_log_results(entries, True), check_log_header(entries, True)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The tests of the manifests below a path, as :func:`parse_manifest_tests` gives them."""
    return parse_manifest_tests(read_texts(spark, path, whole_files=True))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The columns of the catalogs below a path."""
    return parse_catalog(read_texts(spark, path, whole_files=True))


def manifest_models(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Relation descriptions (node_key, description) and column descriptions (node_key, column_name, description)."""
    nodes = manifest_nodes(texts)
    models = nodes.select("node_key", F.col("node.description").alias("description"))
    columns = nodes.select("node_key", F.explode("node.columns").alias("column_name", "column")).select(
        "node_key", "column_name", F.col("column.description").alias("description")
    )
    return models, columns
