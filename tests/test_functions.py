"""Literal cases of the column expressions."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tablewarden.functions import dates, distance, keys, persons, phones


def test_construct_key(spark):
    row = spark.sql("select 'a b' as a, cast(null as string) as b, 'x-y/z' as c")
    assert row.select(keys.construct_key("a", "b")).first()[0] == "A_B_NULL"
    assert row.select(keys.construct_key("a", "b", "c")).first()[0] == "A_B_NULL_X_Y_Z"
    with pytest.raises(ValueError):
        keys.construct_key()
    with pytest.raises(ValueError):
        keys.construct_key(*"abcdef")


def test_surrogate_key(spark):
    import hashlib

    row = spark.sql("select 7 as a, cast(null as string) as b, 'x' as c")
    assert row.select(keys.surrogate_key("a", "b", "c")).first()[0] == hashlib.md5(b"7--x").hexdigest()
    assert row.select(keys.surrogate_key("a")).first()[0] == hashlib.md5(b"7").hexdigest()


def test_phones(values):
    numbers = ["00354-555 1234", "5551234", "+354 555-1234", None, "00", "123456789012"]
    assert values(phones.e164_digits("v"), numbers) == [
        "3545551234", "3545551234", "3545551234", None, "35400", "123456789012",
    ]
    assert values(phones.msisdn("v"), ["555-1234", "+3545551234", "123456", None]) == [
        "+3545551234", "+3545551234", "+123456", None,
    ]


def test_conform_date(values):
    texts = ["31122020", " 31122020 ", "1201", "31021999", None, "3112202", "311220201030", "ab122020"]
    assert values(dates.conform_date("v", "DDMMYYYY"), texts) == [
        date(2020, 12, 31), date(2020, 12, 31), None, None, None, None, date(2020, 12, 31), None,
    ]
    assert values(dates.date_reason("v", "DDMMYYYY"), texts) == [
        None, None, "too short", "invalid", "missing", "too short", None, "invalid",
    ]
    assert values(dates.conform_date("v", "YYYY-MM-DD"), ["2020-12-31 10:00", "2020-2-3"]) == [date(2020, 12, 31), None]
    short = ["010249", "010250", "3002990", "290200"]
    assert values(dates.conform_date("v", "DDMMYY"), short) == [date(2049, 2, 1), date(1950, 2, 1), None, date(2000, 2, 29)]
    with pytest.raises(ValueError):
        dates.conform_date("v", "MMYYYY")


def test_conform_time(values):
    texts = ["5", "930", "1230", "123015", "12:30", "12:30:15", "12:3015", "9:30", "99:99", None, "12", "23:59:60"]
    read = values(dates.conform_time("v", "08:00"), texts)
    assert read == [
        "00:05:00", "09:30:00", "12:30:00", "12:30:15", "12:30:00", "12:30:15", "12:30:15", "08:00:00", "08:00:00",
        "08:00:00", "00:12:00", "08:00:00",
    ]
    assert values(dates.conform_time("v"), ["99:99", None]) == [None, None]
    assert values(dates.conform_time("v", "nonsense"), ["x"]) == [None]
    assert values(dates.second_of_day("v"), ["00:00:00", "23:59:59", None]) == [0, 86399, None]
    assert values(dates.time_reason("v", dates.read_time("v")), ["930", None, "zz"]) == [None, "missing", "invalid"]


def test_birthday(values):
    ids = ["1201743399", "5201743399", "9201743399", "2902693399", "3102693399", "3104743399", "1201743391", None, "120174339",
           "120174339x", "0101012340", "0101851238"]
    assert values(persons.birthday("v"), ids) == [
        date(1974, 1, 12), date(1974, 1, 12), None, date(1969, 2, 28), date(1969, 2, 28), None, None, None, None, None,
        date(2001, 1, 1), date(1885, 1, 1),
    ]


def test_age_and_legal_age(spark):
    def one(sql, column):
        return spark.sql(f"select {sql}").select(column).first()[0]

    assert one("date '2001-01-01' as b, date '2019-01-01' as d", persons.age_in_years("b", "d")) == 17
    assert one("date '2000-01-01' as b, date '2018-01-01' as d", persons.age_in_years("b", "d")) == 18
    legal = persons.of_legal_age("c", "b", "d")
    young, old = "date '2007-06-01' as b, date '2024-06-01' as d", "date '2005-06-01' as b, date '2024-06-01' as d"
    assert one(f"'3' as c, {old}", legal) == 0
    assert one(f"'1' as c, {young}", legal) == 1
    assert one(f"cast(null as string) as c, {young}", legal) == 0
    assert one(f"cast(null as string) as c, {old}", legal) == 1
    assert one("cast(null as string) as c, cast(null as date) as b, date '2024-06-01' as d", legal) == 1


def test_name_parts(values):
    names = ["Jon Orn Jonsson", "Jon Jonsson", "Jon", " A B C D ", "Jon  Jonsson", None, ""]
    first, middle, last = persons.name_parts("v")
    assert values(first, names) == ["Jon", "Jon", "Jon", "A", "Jon", None, ""]
    assert values(middle, names) == ["Orn", "", "Jon", "B C", "", None, ""]
    assert values(last, names) == ["Jonsson", "Jonsson", "Jon", "D", "Jonsson", None, ""]


def test_house_numbers(values):
    texts = ["12-14", "12 og 14", "12a", "7b 2", "12-", "abc", None, "14-12", "9-10-11", "12--14", "1q", "-5-"]
    low, high = persons.house_numbers("v")
    assert values(low, texts) == [12, 12, 12, 7, 12, None, None, 12, 9, None, None, 5]
    assert values(high, texts) == [14, 14, 12, 7, 12, None, None, 14, 11, 14, None, 5]


def test_national_id(values):
    ids = ["1201743399", "1201743389", None, "12017433", "120174339x", "8201743399", "9000000000", "1201743399 "]
    assert values(persons.national_id_error("v"), ids) == [
        None, "checksum", "null", "length", "non_numeric", None, None, None,
    ]
    assert values(persons.national_id_sum(F.col("v")), ["1201743399", None]) == [79, -32]
    assert values(persons.computed_check_digit(persons.national_id_sum(F.col("v"))), ["1201743399", None]) == [9, 21]


def test_edit_distance(spark):
    def between(a, b, maximum=None, fold_case=True):
        df = spark.createDataFrame([(a, b)], "a string, b string")
        return df.select(distance.edit_distance("a", "b", maximum, fold_case)).first()[0]

    assert between("kitten", "sitting") == 3
    assert between("kitten", "sitting", 3) == 3
    assert between("kitten", "sitting", 1) is None
    assert between("KITTEN", "kitten", 0) == 0
    assert between("KITTEN", "kitten", 0, fold_case=False) is None
    assert between(None, "x", 3) is None
