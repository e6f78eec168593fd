"""Comparison, profiles, dimensions, standardisation, definitions, run files."""

import itertools
import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from tablewarden.operators import audit, compare, definitions, dimensions, inventory, profile, standardise
from tablewarden.session import new_shared_path
from tablewarden.sources import glossary, run_files, seed


def test_compare_summary_with_null_and_repeated_keys(spark):
    a = spark.sql("select * from values (1, 'x'), (1, 'x'), (2, 'y'), (null, 'z') as t(k, v)")
    b = spark.sql("select * from values (2, 'y'), (3, 'q'), (null, 'z') as t(k, v)")
    assert tuple(compare.compare_summary(a, b, ["k"]).first()) == (4, 3, 1, 1)
    assert tuple(compare.compare_summary(a, b, ["k", "v"]).first()) == (4, 3, 1, 1)
    assert tuple(compare.compare_summary(a.limit(0), b, ["k"]).first()) == (0, 3, 0, 2)
    assert compare.only_in_first(a, b, ["k"]).count() == 3
    assert compare.only_in_second(a, b, ["k"]).count() == 2


def test_data_difference_is_null_safe(spark):
    a = spark.sql("select * from values (1, 'NULL', 1), (2, null, 2), (3, 'c', 3) as t(k, v, n)")
    b = spark.sql("select * from values (1, null, '1'), (2, null, '2'), (3, 'c', '4') as t(k, v, n)")
    rows = {r.f_k: r.differing_columns for r in compare.data_difference(a, b, ["k"]).collect()}
    assert rows == {1: "v", 3: "n"}
    assert compare.version_difference(a, b, ["k"], ignore=["n"]).columns == ["differing_columns", "f_k", "s_k", "f_v", "s_v"]


def test_data_difference_matches_repeated_keys_one_to_one(spark):
    a = spark.sql("select * from values (1, 'x'), (1, 'x'), (1, 'y'), (2, 'a'), (3, 'q'), (null, 'n') as t(k, v)")
    b = spark.sql("select * from values (1, 'x'), (1, 'z'), (2, 'a'), (2, 'b'), (4, 'q'), (null, 'm') as t(k, v)")
    rows = [tuple(r) for r in compare.data_difference(a, b, ["k"]).collect()]
    # Key 1 keeps x and y against z; key 2 keeps only b; keys of one side and NULL keys are left out.
    assert sorted((r[1] or r[2]) for r in rows) == [1, 1, 2]
    assert all(r[0] == "v" for r in rows)
    assert sorted(r[3] for r in rows if r[1] == 1) == ["x", "y"] and [r[4] for r in rows if r[2] == 1] == ["z"]
    assert [r[1:] for r in rows if r[2] == 2] == [(None, 2, None, "b")]
    assert compare.data_difference(a, a, ["k"]).count() == 0
    assert compare.data_difference(a.limit(0), b, ["k"]).count() == 0
    assert compare.data_difference(a, b, ["k", "v"]).count() == 0


def test_data_difference_cuts_a_hot_key_into_parts(spark, monkeypatch):
    a = spark.range(3000).selectExpr("id % 2 as k", "id as v", "cast(id as int) as n")
    b = spark.range(3000).selectExpr("id % 2 as k", "id + 3000 as v", "cast(id as string) as n").filter("v < 5900")
    whole = sorted(map(str, compare.data_difference(a, b, ["k"]).collect()))
    monkeypatch.setattr(compare, "ROWS_IN_ORDER", 7)
    cut = compare.data_difference(a, b, ["k"])
    assert sorted(map(str, cut.collect())) == whole and len(whole) == 3000
    assert cut.filter("f_k = s_k").count() == 2900
    assert dict(cut.dtypes)["f_n"] == "int" and dict(cut.dtypes)["s_n"] == "string"
    assert cut.select("f_v").distinct().count() == 3000 and cut.filter("s_v is not null").select("s_v").distinct().count() == 2900


def test_row_difference_counts_copies(spark):
    a = spark.sql("select * from values (1, 'x'), (1, 'x'), (2, null), (3, 'z') as t(k, v)")
    b = spark.sql("select * from values (1, 'x'), (2, null), (3, 'y') as t(k, v)")
    assert {tuple(r) for r in compare.row_difference(a, b).collect()} == {(1, "x", 2, 1), (3, "z", 1, 0), (3, "y", 0, 1)}
    assert compare.row_difference(a, b.selectExpr("cast(k as string) k", "v")).count() == 3
    assert compare.row_difference(a, b, ignore=["v"]).collect()[0].asDict() == {"k": 1, "first_count": 2, "second_count": 1}


def test_schema_drift(spark):
    spark.sql("drop table if exists drift_a")
    spark.sql("create table drift_a (id bigint, name varchar(10), note string, amount decimal(9,2)) using parquet")
    public = inventory.column_inventory(spark, {("p", "t"): spark.table("drift_a")})
    held = public.withColumn("char_length", F.when(F.col("column_name") == "name", 5).otherwise(F.col("char_length"))).withColumn(
        "data_type", F.when(F.col("column_name").isin("note", "amount"), "int").otherwise(F.col("data_type"))
    )
    drift = {r.column_name: r.corrective_type for r in compare.schema_drift(public, held).collect()}
    assert drift == {"name": "varchar(10)", "note": "varchar(8000)", "amount": "decimal(9,2)"}


def test_inventory_types(spark):
    spark.sql("drop table if exists inv_a")
    spark.sql("create table inv_a (id int, name varchar(10), note string, amount decimal(9,2), d date) using parquet")
    read = [tuple(r)[2:8] for r in inventory.column_inventory(spark, {("p", "t"): spark.table("inv_a")}).orderBy("ordinal").collect()]
    assert read == [
        ("id", 1, "int", 0, 10, 0), ("name", 2, "varchar", 10, 0, 0), ("note", 3, "string", -1, 0, 0),
        ("amount", 4, "decimal", 0, 9, 2), ("d", 5, "date", 0, 0, 0),
    ]


def test_profiles_of_days_merge_without_the_table(spark):
    df = spark.sql(
        "select case when id < 900 then date'2024-01-01' + cast(id % 9 as int) end as d, id as v, "
        "case id % 4 when 0 then null when 1 then '' else 'x' end as few, cast(null as string) as `none.at all` from range(1000)")
    path = new_shared_path(spark, "profile")
    profile.store_profile(df, "d", path)
    profile.store_profile(df.filter("d >= date'2024-01-08'"), "d", path)  # a repeated day is replaced

    def read(*days):
        rows = profile.profile_of_days(spark.read.parquet(path), *days).collect()
        return [(r.column_name, r.distinct_values, r.row_count, r.filled_rows) for r in rows]

    def close(found, exact):
        return abs(found - exact) <= 0.08 * exact

    three = read(date(2024, 1, 2), date(2024, 1, 4))
    assert [r[0] for r in three] == ["none.at all", "few", "v"] and [r[2] for r in three] == [300] * 3
    assert three[0][1:] == (0, 300, 0) and three[1][1] == 2 and three[1][3] == 225 and close(three[2][1], 300)
    everything = read()
    assert [r[2] for r in everything] == [1000] * 3 and close(everything[2][1], 1000)
    assert read(date(2030, 1, 1)) == []
    plan = profile.profile_of_days(spark.read.parquet(path), date(2024, 1, 2), date(2024, 1, 4))
    assert "PartitionFilters: [isnotnull(day" in plan._jdf.queryExecution().executedPlan().toString()


def test_distinct_profile_and_clustering(spark):
    df = spark.range(100).selectExpr("id", "id % 3 as few", "if(id % 2 = 0, null, 'x') as one", "id % 10 as some")
    assert [(r.column_name, r.distinct_values) for r in profile.distinct_profile(df).collect()] == [
        ("one", 1), ("few", 3), ("some", 10), ("id", 100),
    ]
    assert profile.storage_order(profile.distinct_profile(df)).first()[0] == "[one], [few], [some], [id]"
    path = new_shared_path(spark, "clustered")
    assert profile.cluster_by_cardinality(df, path, partitions=4) == ["one", "few", "some", "id"]
    assert spark.read.parquet(path).exceptAll(df).count() == 0


def test_row_search_skips_nulls(spark):
    df = spark.sql("select * from values (1, null, 'Abc'), (2, 'x', 'def') as t(a, b, c)")
    assert [r.row_text for r in profile.row_search(df, "1||A").collect()] == ["1||Abc"]
    assert profile.row_search(df, "abc").count() == 0
    assert profile.row_search(df, "ABC", fold_case=True).count() == 1


def test_date_dimension(spark):
    days = {r.id: r for r in dimensions.date_dimension(dimensions.days_between(spark)).collect()}
    assert len(days) == 11323
    assert [days[d].week_of_year for d in (date(2010, 1, 1), date(2010, 1, 3), date(2010, 1, 4), date(2012, 12, 31))] == [1, 1, 2, 54]
    assert (days[date(2021, 1, 1)].iso_week_of_year, days[date(2021, 1, 1)].iso_year) == (53, 2020)
    assert (days[date(2018, 12, 31)].iso_week_of_year, days[date(2018, 12, 31)].iso_year) == (1, 2019)
    d = days[date(2024, 2, 29)]
    assert (d.weekday, d.weekday_name, d.month_name, d.month_short_name) == (4, "Fimmtudagur", "Febrúar", "Feb")
    assert (d.month_end, d.next_month_start, d.next_month_end) == (date(2024, 2, 29), date(2024, 3, 1), date(2024, 3, 31))
    assert (d.quarter_start, d.quarter_end, d.is_leap_year, d.weekday_of_month) == (date(2024, 1, 1), date(2024, 3, 31), 1, 5)
    assert len(dimensions.DATE_COLUMNS_ICELANDIC) == len(d)
    named = dimensions.date_dimension(dimensions.days_between(spark, date(2024, 1, 1), date(2024, 1, 1)), names=dimensions.DATE_COLUMNS_ICELANDIC)
    assert named.columns == list(dimensions.DATE_COLUMNS_ICELANDIC.values())
    assert dimensions.time_dimension(spark, dimensions.TIME_COLUMNS_ICELANDIC).columns == list(dimensions.TIME_COLUMNS_ICELANDIC.values())


def test_time_dimension(spark):
    times = dimensions.time_dimension(spark)
    assert times.count() == 86400
    assert tuple(times.filter("id = '08:05:09'").first()) == ("08:05:09", 8, 5, 9, 1, 0, 1, 0)


def test_fuzzy_match_finds_every_pair(spark):
    words = ["".join(w) for n in range(1, 5) for w in itertools.product("ab", repeat=n)] + ["Abba", "a c", "ab"]
    left = spark.createDataFrame([(w,) for w in words] + [(None,)], "w string")
    for maximum in (0, 1, 2):
        matched = standardise.fuzzy_match(left, "w", left, "w", maximum)
        brute = spark.sql(
            f"""with d as (select lower(w) as w, count(*) as n from {{t}} where w is not null group by 1)
                select a.w, b.w, levenshtein(a.w, b.w), a.n, b.n from d a join d b on levenshtein(a.w, b.w) <= {maximum}""",
            t=left,
        )
        assert sorted(map(tuple, matched.collect())) == sorted(map(tuple, brute.collect()))
    plan = standardise.fuzzy_match(left, "w", left, "w", 1)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    with pytest.raises(ValueError):
        standardise.fuzzy_match(left, "w", left, "w", None)


def test_quarantine(spark):
    df = standardise.conform_dates(spark.createDataFrame([("31122020",), ("x",), (None,)], "t string"), "t", "DDMMYYYY")
    good, bad = standardise.quarantine(df)
    assert (good.count(), bad.count()) == (1, 2)
    assert {r.reason: r.row_count for r in standardise.quarantine_counts(df).collect()} == {"ok": 1, "too short": 1, "missing": 1}


def test_key_collisions(spark):
    df = spark.sql("select * from values ('a b', 'c'), ('a-b', 'c'), ('a b', 'c'), ('a', 'b_c'), ('x', 'y') as t(p, q)")
    assert [tuple(r) for r in standardise.key_collisions(df, ["p", "q"]).collect()] == [("A_B_C", 3)]


def test_resolve_country(spark):
    countries = spark.sql("select * from values ('i', 'IS', 'Ísland'), ('n', 'no', 'Noregur') as t(id, alpha_2_code, name)")
    people = spark.sql("""select * from values (1, '101', '00no', 'noregur'), (2, '1010', '00NO', 'x'), (3, null, null, 'NOREGUR'),
        (4, null, '00xx', 'ísland'), (5, null, null, 'nowhere') as t(k, p, c, a)""")
    read = {r.k: r.country_id for r in standardise.resolve_country(people, countries, "p", "c", "a").collect()}
    assert read == {1: "i", 2: "n", 3: "n", 4: "i", 5: None}


def test_countries_without_a_code_or_with_two_names(spark):
    countries = spark.sql("""select * from values (1, 'is', 'Ísland'), (2, null, 'Kosovo'), (3, 'gb', 'United Kingdom'),
        (4, 'gb', 'England'), (5, '', 'Nowhere'), (6, 'xyz', 'Long code') as t(id, alpha_2_code, name)""")
    people = spark.sql("""select * from values (1, null, null, 'kosovo'), (2, null, '00gb', 'x'), (3, null, null, 'England'),
        (4, null, null, 'long code') as t(k, p, c, a)""")
    read = {r.k: r.country_id for r in standardise.resolve_country(people, countries, "p", "c", "a").collect()}
    assert read == {1: 2, 2: 3, 3: 4, 4: 6}


@pytest.mark.parametrize("maximum", [0, 1, 2, 3])
def test_fuzzy_match_finds_every_pair(spark, maximum):
    import random
    dice = random.Random(maximum)
    words = {"".join(dice.choice("abc") for _ in range(dice.randint(0, 9))) for _ in range(70)} | {"x" * 300, "x" * 298 + "y"}
    left, right = sorted(words)[::2], sorted(words)[1::2] + ["x" * 299]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            row, before = [i], row
            for j, d in enumerate(b, 1):
                row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (c != d)))
        return row[-1]

    found = standardise.fuzzy_match(
        spark.createDataFrame([(w,) for w in left], "v string"), "v",
        spark.createDataFrame([(w,) for w in right], "w string"), "w", maximum)
    expected = {(a, b, d) for a in left for b in right if (d := distance(a, b)) <= maximum}
    assert {(r.left_value, r.right_value, r.distance) for r in found.collect()} == expected


@pytest.mark.parametrize("maximum", [None, 0, 2])
def test_fuzzy_match_inside_blocks(spark, maximum):
    left = [("hot", f"name {i % 40}") for i in range(60)] + [("b", "Anna"), ("b", None), (None, "name 1"), ("left", "x")]
    right = [("hot", f"nam {i}") for i in range(25)] + [("b", "anna"), ("b", ""), (None, "name 1"), ("right", "x")]
    a, b = (spark.createDataFrame(rows, "area string, v string") for rows in (left, right))
    found = standardise.fuzzy_match_blocked(a, "v", b, "v", ["area"], maximum, chunk=7)
    brute = spark.sql(
        """with a as (select area, lower(v) as v, count(*) as n from {a} group by all),
                b as (select area, lower(v) as v, count(*) as n from {b} group by all)
           select area, a.v, b.v, levenshtein(a.v, b.v), a.n, b.n from a join b using (area)
           where a.v is not null and b.v is not null""",
        a=a, b=b,
    )
    expected = [tuple(r) for r in brute.collect() if maximum is None or r[3] <= maximum]
    assert found.columns == ["area", "left_value", "right_value", "distance", "left_rows", "right_rows"]
    assert sorted(map(tuple, found.collect())) == sorted(expected) and expected
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    empty = standardise.fuzzy_match_blocked(a.where("false"), "v", b, "v", ["area"], maximum)
    assert empty.count() == 0
    with pytest.raises(ValueError):
        standardise.fuzzy_match_blocked(a, "v", b, "v", [], maximum)


def test_best_match_ranks(spark):
    concepts = spark.sql("""select * from values ('Name', 'd', 'name', 'VARCHAR', 50), ('Ten', 'd', 'ten', 'INT', -1),
        ('Id', 'd', 'id', 'BIGINT', -1), ('N me', 'd', 'n_me', 'INT', -1) as t(concept_name, description, column_name, type_id, max_length)""")
    names = ["name", "name_id", "name_x", "x_name", "x_name_id", "other", "id", "often", "xid", "tename"]
    inv = spark.createDataFrame([("s", "r", n) for n in names], "schema_name string, relation_name string, column_name string")
    read = {r.column_name: (r.concept_name, r.match_type_id) for r in definitions.glossary_best_match(concepts, inv).collect()}
    assert read == {
        "name": ("Name", 1), "name_id": ("Name", 2), "name_x": ("Name", 3), "x_name": ("Name", 4), "x_name_id": ("Name", 5),
        "other": ("", 0), "id": ("Id", 1), "often": ("Ten", 4), "xid": ("", 0), "tename": ("Ten", 3),
    }


ENRICHED = (
    "database_name string, schema_name string, relation_name string, column_name string, relation_description string, "
    "column_description string, type_name string, max_length int, numeric_precision int, numeric_scale int, "
    "glossary_name string, glossary_description string, glossary_data_type string, glossary_max_length int"
)


@pytest.fixture
def enriched(spark):
    return spark.createDataFrame(
        [
            ("d", "s", "r", "a", "", "", "varchar", 10, 0, 0, "a", "concept", "VARCHAR", 10),
            ("d", "s", "r", "b", "", "own", "varchar", 10, 0, 0, "b", "concept", "varchar", 20),
            ("d", "s", "r", "c", "", "", "int", 0, 10, 0, None, None, None, None),
            ("d", "s", "r", "d_id", "", "own", "bigint", 0, 19, 0, "id", "concept", "int", -1),
            ("d", "s", "q", "e", "", "own", None, None, None, None, "e", "", "int", -1),
            ("d", "hidden", "q", "e", "", "", None, None, None, None, None, None, None, None),
        ],
        ENRICHED,
    )


def test_definition_health(spark, enriched):
    public = definitions.public_only(enriched, ["s"])
    tests = spark.createDataFrame(
        [("d", "s", "r", "a"), ("d", "s", "r", "a"), ("d", "s", "r", None)],
        "database_name string, schema_name string, relation_name string, column_name string",
    )
    assert [r.column_name for r in definitions.documentation_errors(public).collect()] == ["c"]
    assert [r.column_name for r in definitions.concept_overwrites(public).collect()] == ["b"]
    assert definitions.concept_overwrites(public, ["other"]).count() == 0
    assert {r.column_name: r.message for r in definitions.type_errors(public).collect()} == {
        "b": "Lengd gagnatýpu í skilgreiningu hugtaks: 20 - Lengd í grunni: 10",
        "d_id": "Gagnatýpa í skilgreiningu hugtaks: int - Gagnatýpa í grunni: bigint",
        "e": "Gagnatýpa í skilgreiningu hugtaks: int - Gagnatýpa í grunni: UNKNOWN",
    }
    assert definitions.column_test_coverage(tests).first().test_count == 2
    assert definitions.relation_test_coverage(tests).first().test_count == 3
    assert [r.column_name for r in definitions.test_coverage_errors(public, tests).collect()] == ["e", "b", "c", "d_id"]
    stats = {(r.schema_name, r.relation_name): r for r in definitions.definition_stats(enriched, tests, ["s"]).collect()}
    total = stats[None, None]
    assert (total.relation_count, total.column_count, total.ok_count, total.error_count) == (2, 5, 1, 8)
    assert total.error_percentage == 160.0
    assert stats["s", "r"].ok_percentage == 25.0
    docs = {r.column_name: (r.type_name, r.type_length, r.origin, r.missing) for r in definitions.documentation_table(enriched, ["s"]).collect()}
    assert docs == {
        "a": ("varchar", "10", "Hugtök", 0), "b": ("varchar", "10", "Athugasemd við dálk", 0), "c": ("int", "10, 0", None, 1),
        "d_id": ("bigint", "19, 0", "Athugasemd við dálk", 0), "e": ("UNKNOWN", "Metadata missing!", "Athugasemd við dálk", 0),
    }


def test_definition_stats_without_columns(spark, enriched):
    tests = spark.createDataFrame([], "database_name string, schema_name string, relation_name string, column_name string")
    total = definitions.definition_stats(enriched, tests, ["nowhere"]).collect()
    assert len(total) == 1 and total[0].column_count == 0 and total[0].ok_percentage == 0.0


def test_read_check_log(spark, tmp_path):
    entries = [
        {"info": {"name": "MainReportVersion", "ts": "t", "invocation_id": "i"}, "data": {"version": "=1.5"}},
        {"info": {"name": "LogTestResult"}, "data": {"node_info": {"node_name": "n", "unique_id": "u", "node_path": "p"}, "status": "fail", "num_failures": 3}},
        {"info": {"name": "Other"}, "data": {"status": "LogTestResult"}},
    ]
    (tmp_path / "joined.json").write_text("".join(json.dumps(e, indent=2) for e in entries))
    whole = run_files.read_texts(spark, str(tmp_path / "joined.json"), whole_files=True)
    assert [tuple(r) for r in run_files.check_log_results(whole).collect()] == [("n", "u", "p", "fail", 3)]
    assert [tuple(r) for r in run_files.check_log_header(whole).collect()] == [("1.5", "t", "i")]
    assert run_files.parse_check_log(whole).count() == 3
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(e) for e in entries))
    lines = run_files.read_texts(spark, str(tmp_path / "lines.json"))
    assert run_files.check_log_results(lines).count() == 1


def test_manifest_targets(spark):
    nodes = {
        "model.p.a": {"resource_type": "model", "name": "a", "schema": "sa"},
        "model.p.ab": {"resource_type": "model", "name": "ab", "schema": "sab"},
        "test.p.one": {"resource_type": "test", "unique_id": "test.p.one", "database": "d", "refs": [{"name": "a"}], "column_name": "c"},
        "test.p.two": {"resource_type": "test", "unique_id": "test.p.rel_ab_in_a", "database": "d", "refs": [{"name": "ab"}, {"name": "zz"}]},
        "test.p.none": {"resource_type": "test", "unique_id": "test.p.none", "database": "d", "refs": []},
    }
    texts = spark.createDataFrame([(json.dumps({"nodes": nodes}),)], "value string")
    read = {r.unique_id: (r.schema_name, r.relation_name, r.column_name) for r in run_files.parse_manifest_targets(texts).collect()}
    assert read == {"test.p.one": ("sa", "a", "c"), "test.p.rel_ab_in_a": ("sab", "ab", None), "test.p.none": (None, None, None)}


def test_read_glossaries(spark, tmp_path):
    csv = tmp_path / "g.csv"
    csv.write_text('column_name,name,description,data_type,max_length\na,A,"first, ""one""",int,\na,A2,second,varchar,20\nb,B,"two\nlines",int,5\n')
    read = {r.column_name: tuple(r)[1:] for r in glossary.read_glossary_csv(spark, str(csv)).collect()}
    assert read == {"a": ("A2", "second", "varchar", 20), "b": ("B", "two\nlines", "int", 5)}
    js = tmp_path / "g.json"
    js.write_text(json.dumps([{"column_name": "id", "description": "x", "data_type": "nvarchar", "max_length": "250"}, {"column_name": "k", "description": "y", "data_type": "int"}]))
    read = {r.column_name: tuple(r)[1:] for r in glossary.read_glossary_json(spark, str(js)).collect()}
    assert read == {"id": ("id", "x", "nvarchar", 250), "k": ("k", "y", "int", -1)}


def test_seed(spark, tmp_path):
    df = spark.sql("select * from values (1, 'a,b'), (2, null) as t(id, v)")
    assert seed.seed_header(df) == "id,v"
    assert sorted(r.line for r in seed.seed_lines(df).collect()) == ['"1","a,b"', '"2",""']
    seed.export_seed(df.coalesce(1), str(tmp_path / "seed"))
    [part] = list((tmp_path / "seed").glob("part-*.csv"))
    assert part.read_text().splitlines()[1:] == ['"1","a,b"', '"2",""']


def test_append_audit(spark):
    path = new_shared_path(spark, "audit")
    runs = spark.sql("select 'r' as id, timestamp_ntz'2024-01-01 10:00:00' as start_time")
    audit.append_audit(runs, path)
    audit.append_audit(runs, path)
    assert spark.read.parquet(path).count() == 2


def test_top_actions_limit_and_share(spark):
    runs = spark.sql("""select * from values ('r1', 'refresh', 'success', 'x', 100.0D, timestamp'2024-01-01 00:00:00'),
        ('r2', 'refresh', 'success', 'x', 200.0D, timestamp'2024-01-02 00:00:00'), ('r3', 'refresh', 'error', 'x', 9.0D, timestamp'2024-01-03 00:00:00')
        as t(id, operation, status, parameters, execution_time_in_seconds, start_time)""")
    actions = spark.sql("select * from values ('r2', 'a', 50.0D, 'success'), ('r2', 'b', 100.0D, 'success'), ('r1', 'c', 1.0D, 'success') as t(invocation_id, unique_id, execution_time_in_seconds, status)")
    assert [tuple(r)[:3] for r in audit.top_expensive_actions(runs, actions, "refresh", n=1).collect()] == [("b", 100.0, 50.0)]


def test_run_files_from_disk(spark, tmp_path):
    manifest = {"nodes": {
        "model.p.orders": {"resource_type": "model", "unique_id": "model.p.orders", "name": "orders", "schema": "sales",
                           "relation_name": '"db"."sales"."orders"', "description": "All orders",
                           "columns": {"id": {"name": "id", "description": "Key"}, "n": {"name": "n"}}},
        "test.p.t1": {"resource_type": "test", "unique_id": "test.p.t1", "database": "db", "path": "t1.sql", "compiled_path": "c/t1.sql",
                      "file_key_name": "models.orders", "depends_on": {"nodes": ["source.x.orders", "model.p.orders"]}},
        "test.p.t2": {"resource_type": "test", "unique_id": "test.p.t2", "database": "db", "path": "t2.sql", "compiled_path": "c/t2.sql",
                      "compiled_code": "select 1", "file_key_name": "models.other", "depends_on": {"nodes": ["model.p.orders"]}},
    }}
    catalog = {"nodes": {"model.p.orders": {"metadata": {"database": "db", "schema": "sales", "name": "orders"},
                                            "columns": {"id": {"name": "id", "index": 1}, "n": {"name": "n", "index": 2}}}}}
    results = {"metadata": {"dbt_version": "1.5", "invocation_id": "run"}, "elapsed_time": 3.5, "args": {"which": "run"},
               "results": [{"unique_id": "model.p.orders", "status": "success", "execution_time": 2.0, "thread_id": "T1",
                            "adapter_response": {"rows_affected": 7}},
                           {"unique_id": "model.p.gone", "status": "error", "execution_time": 0.1, "thread_id": "T2", "adapter_response": {}}]}
    for name, content in (("manifest", manifest), ("catalog", catalog), ("results", results)):
        (tmp_path / f"{name}.json").write_text(json.dumps(content, indent=2))

    def path(name):
        return str(tmp_path / f"{name}.json")

    tests = {r.unique_id: (r.schema_name, r.relation_name, r.sql) for r in run_files.read_manifest(spark, path("manifest")).collect()}
    assert tests == {"test.p.t1": ("sales", "orders", "Not found!"), "test.p.t2": ("UNKNOWN", "UNKNOWN", "select 1")}
    columns = run_files.read_catalog(spark, path("catalog"))
    assert {(r.schema_name, r.relation_name, r.column_name, r.ordinal) for r in columns.collect()} == {
        ("sales", "orders", "id", 1), ("sales", "orders", "n", 2),
    }
    models, described = run_files.manifest_models(run_files.read_texts(spark, path("manifest"), whole_files=True))
    inv = spark.createDataFrame([("sales", "orders", "id", "bigint", 0, 19, 0)], "schema_name string, relation_name string, "
                                "column_name string, data_type string, char_length int, numeric_precision int, numeric_scale int")
    enriched = definitions.enrich_catalog(columns, models, described, inv, definitions.empty_glossary(columns))
    read = {r.column_name: (r.relation_description, r.column_description, r.type_name, r.glossary_name) for r in enriched.collect()}
    assert read == {"id": ("All orders", "Key", "bigint", ""), "n": ("All orders", "", None, "")}
    from datetime import datetime

    runs, actions = audit.ingest_run_results(spark, path("results"), path("manifest"), "parent", "refresh", "success", datetime(2024, 1, 1))
    run = runs.first()
    assert (run.id, run.parent_run_id, run.execution_time_in_seconds, run.parameters) == ("run", "parent", 3.5, '{"which":"run"}')
    assert {tuple(r) for r in actions.collect()} == {
        ("run", "model.p.orders", "db.sales.orders", "success", 2.0, 7, "T1"), ("run", "model.p.gone", "", "error", 0.1, 0, "T2"),
    }


def test_approximate_profile_is_close(spark):
    df = spark.range(20000).selectExpr("id", "id % 100 as few")
    read = {r.column_name: r.distinct_values for r in profile.distinct_profile(df, approximate=True).collect()}
    assert abs(read["id"] - 20000) < 2000 and abs(read["few"] - 100) < 10


def test_footprint(spark):
    path = new_shared_path(spark, "footprint")
    spark.range(1000).selectExpr("id", "id % 3 as p").repartition(2).write.partitionBy("p").parquet(path)
    tables = {("s", "t"): spark.read.parquet(path)}
    row = profile.footprint(tables, minimum_mb=0).first()
    assert (row.schema_name, row.relation_name, row.partition_count, row.file_count, row.row_count) == ("s", "t", 3, 6, 1000)
    assert row.total_bytes > 0 and row.rows_per_mb > 0
    assert profile.footprint(tables, minimum_mb=100).count() == 0
