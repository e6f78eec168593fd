"""Run files: entries that are hard to divide, manifests of many nodes, tests that several manifests hold."""

import json

from tablewarden.operators import definitions, health, history
from tablewarden.session import new_shared_path
from tablewarden.sources import run_files


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def entry(name, **data):
    return json.dumps({"info": {"name": name, "ts": "t", "invocation_id": "i"}, "data": data})


def test_log_entries_divide_outside_strings_only(spark):
    one = entry("LogTestResult", node_info={"node_name": 'a}{b"\\{', "unique_id": "u1", "node_path": "}\n{"}, status="pass", num_failures=0)
    two = entry("LogTestResult", node_info={"node_name": "c", "unique_id": "u2", "node_path": "p"}, status="fail", num_failures=3)
    pretty = json.dumps(json.loads(two), indent=2).replace("u2", "u3")
    cut = '{"info": {"name": "LogTestResult", "ts": "a b'
    log = texts(spark, one + two, one + "\n" + pretty + "\r\n" + two, two + cut, "", " \n", None)
    assert sorted((r.test_name, r.unique_id) for r in run_files.check_log_results(log).collect()) == [
        ('a}{b"\\{', "u1"), ('a}{b"\\{', "u1"), ("c", "u2"), ("c", "u2"), ("c", "u2"), ("c", "u3")]
    assert [tuple(r) for r in run_files.check_log_corrupt(log).collect()] == [(cut, 1)]


def test_a_log_file_with_an_entry_over_several_lines(spark, tmp_path):
    text = json.dumps(json.loads(entry("LogTestResult", node_info={"unique_id": "u"}, status="pass")), indent=1)
    (tmp_path / "log.json").write_text(text + "\n" + text)
    results, _ = run_files.read_check_log(spark, str(tmp_path))
    assert results.count() == 2


def manifest(parts, label="x"):
    nodes = {}
    for i in range(parts):
        nodes[f"model.{i}"] = {"resource_type": "model", "unique_id": f"model.{i}", "schema": f"s{i}", "name": f"m{i}"}
        nodes[f"test.{i}"] = {
            "resource_type": "test", "unique_id": f"test.{i}.m{i}", "database": label, "file_key_name": f"models.{i}",
            "depends_on": {"nodes": ["gone.0", f"model.{i}"]}, "refs": [{"name": f"m{i}"}] if i % 2 else [], "path": "p"}
    return json.dumps({"nodes": nodes})


def test_manifest_of_many_nodes(spark):
    found = run_files.parse_manifest_tests(texts(spark, manifest(300), manifest(2, "y")))
    rows = {(r.database_name, r.unique_id): (r.schema_name, r.relation_name) for r in found.collect()}
    assert len(rows) == 302 and rows["x", "test.7.m7"] == ("s7", "m7") and rows["y", "test.1.m1"] == ("s1", "m1")
    targets = {r.unique_id: (r.schema_name, r.relation_name) for r in run_files.parse_manifest_targets(texts(spark, manifest(9))).collect()}
    assert targets["test.3.m3"] == ("s3", "m3") and targets["test.4.m4"] == (None, None)


def test_entries_of_a_test_in_two_manifests_or_in_none(spark):
    tests = run_files.parse_manifest_tests(texts(spark, manifest(2), manifest(2, "y")))
    log = spark.createDataFrame([("a", "test.1.m1", "f", "fail", 1), ("b", "nowhere", "f", "warn", 2)],
                                "test_name string, unique_id string, sql_filename string, status string, num_failures bigint")
    rows = {r.unique_id: r for r in health.attribute_tests(log, tests).collect()}
    assert len(rows) == 2 and rows["test.1.m1"].relation_name == "m1"
    assert (rows["nowhere"].database_name, rows["nowhere"].relation_name, rows["nowhere"].sql) == ("UNKNOWN", "UNKNOWN", "Not found!")


def test_tests_without_a_relation_count_nowhere(spark):
    tests = spark.createDataFrame([("d", "s", "r", "c"), ("d", "s", "r", None), ("d", None, None, "c")],
                                  "database_name string, schema_name string, relation_name string, column_name string")
    assert [r.test_count for r in definitions.relation_test_coverage(tests).collect()] == [2]
    assert [r.test_count for r in definitions.column_test_coverage(tests).collect()] == [1]


def test_history_after_an_empty_load_and_with_a_new_column(spark):
    from datetime import date
    root = new_shared_path(spark, "scd2-test")
    rows = spark.createDataFrame([(1, "a", None), (2, "b", 5)], "k int, v string, w int")
    history.scd2_run(spark, root, rows.limit(0).select("k", "v"), "k", ["v"], date(2024, 1, 1))
    history.scd2_run(spark, root, rows.select("k", "v"), "k", ["v"], date(2024, 1, 2))
    history.scd2_run(spark, root, rows, "k", ["v", "w"], date(2024, 1, 3))
    found = history.scd2_history(spark, root).collect()
    assert sorted((r.k, r.w, r.valid_from.day, r.is_current) for r in found if r.k == 1) == [(1, None, 2, True)]
    assert sorted((r.w is None, r.is_current) for r in found if r.k == 2) == [(False, True), (True, False)]
    assert history.scd2_history(spark, root, date(2024, 1, 1)).count() == 0


def entries_by_reading(text):
    """The entries of a log of lines, read line by line."""
    found, open_braces, closed, broken = [], 0, False, False
    for line in text.split("\n"):
        pieces, piece, i, in_string = [], "", 0, False
        while i < len(line):
            sign = line[i]
            piece += sign
            if in_string and sign == "\\":
                piece += line[i + 1:i + 2]
                i += 1
            elif sign == '"':
                in_string = not in_string
            elif sign == "}" and not in_string and line[i + 1:].lstrip().startswith("{"):
                pieces.append((piece, False))
                piece = ""
            i += 1
        pieces.append((piece, in_string))
        for number, (piece, in_string) in enumerate(pieces):
            if not piece.strip():
                continue
            divided = number > 0 or piece.strip()[0] == "{" and closed or broken
            if divided or open_braces == 0:
                found.append([])
            if divided:
                open_braces = 0
            found[-1].append(piece)
            bare, quoted, j = "", False, 0
            while j < len(piece):
                if quoted and piece[j] == "\\":
                    j += 1
                elif piece[j] == '"':
                    quoted = not quoted
                elif not quoted:
                    bare += piece[j]
                j += 1
            open_braces = max(0, open_braces + bare.count("{") - bare.count("}"))
            broken, closed = in_string, piece.strip()[-1] == "}" and not in_string
    return ["\n".join(e) for e in found]


def test_lines_of_a_log_cut_into_ranges(spark):
    import random

    schema = "log string, block int, at int, value string"
    tokens = ["{", "}", '"', "\n", "\n", " ", "\\\\", '\\"', "a", "}{", "}\n{", '{"a": {"b": 1}}', "text", '"}{"', "{\n", "}\n"]
    rows, expected = [], []
    for log in range(150):
        dice = random.Random(log)
        text = "".join(dice.choice(tokens) for _ in range(dice.randint(1, 40)))
        cuts = dice.choice([0.0, 0.3, 1.0])
        block = 0
        for at, line in enumerate(text.split("\n")):
            block += dice.random() < cuts
            rows.append((f"log{log}", block, at, line))
        expected += entries_by_reading(text)
    lines = spark.createDataFrame(rows, schema).repartition(5)
    found = sorted(r.value for r in run_files.stitched_entries(lines).collect())
    assert found == sorted(expected)


def test_a_log_read_in_many_ranges(spark, tmp_path):
    import random

    dice = random.Random(2)
    texts_of = []
    for i in range(200):
        one = entry("LogTestResult", node_info={"node_name": "}{" * (i % 3), "unique_id": f"u{i}", "node_path": "p\n{"}, status="pass", num_failures=i)
        shape = dice.random()
        texts_of.append(json.dumps(json.loads(one), indent=1) if shape < 0.4 else one)
        if shape > 0.9:
            texts_of.append("plain words between entries")
        if shape > 0.95:
            texts_of.append('{"info": {"name": "LogTestResult", "ts')
    (tmp_path / "a.log").write_text("\n".join(texts_of))
    (tmp_path / "b.log").write_text("".join(t for t in texts_of if t.startswith("{") and t.endswith("}")))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    try:
        lines = run_files.read_log_lines(spark, str(tmp_path))
        assert lines.select("log", "block").distinct().count() > 50
        found = run_files.read_check_log(spark, str(tmp_path))[0].groupBy("unique_id").count().collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.unique_id, r["count"]) for r in found) == sorted((f"u{i}", 2) for i in range(200))


def test_lines_in_order_cut_into_ranges(spark):
    import random

    tokens = ["{", "}", '"', "\n", "\n", " ", "\\\\", '\\"', "a", "}\n{", '{"a": {"b": 1}}\n', '{"a": 1}{"b": 2}\n', '"}{"', "}\n", '{"cut\n']
    rows, expected = [], []
    for log in range(300):
        dice = random.Random(log)
        text = "".join(dice.choice(tokens) for _ in range(dice.randint(1, 60)))
        cuts = dice.choice([0.0, 0.1, 0.4])
        block = 0
        for at, line in enumerate(text.split("\n")):
            block += dice.random() < cuts
            rows.append((f"log{log:03}", block, at, line))
        expected += entries_by_reading(text)
    lines = spark.createDataFrame(rows, "log string, block int, at int, value string").repartition(3, "log").sortWithinPartitions("log", "at")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = sorted(r.value for r in run_files.stitched_entries(lines).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert found == sorted(expected)


def test_lines_of_whole_entries_are_not_moved(spark, tmp_path):
    """Of a log of whole lines only the ends of its ranges and the one spread entry are written again."""
    import glob

    one = [entry("LogTestResult", node_info={"unique_id": f"u{i}"}, status="pass") for i in range(2000)]
    one[700] = one[700].replace('"data"', '\n"data"')
    one[900] = '{"info": {"name": "LogTestResult", "ts'
    (tmp_path / "a.log").write_text("\n".join(one))
    pieces = f"{spark.conf.get('spark.checkpoint.dir')}/tablewarden/log-pieces-*"
    before = set(glob.glob(pieces))
    assert run_files.read_check_log(spark, str(tmp_path))[0].count() == 1999
    new = set(glob.glob(pieces)) - before
    assert len(new) == 1 and spark.read.parquet(*new).count() < 50
