import hashlib
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from turnstile import functions as fn
from turnstile.fixed import FILE_NAME_LOOSE


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("mary-jane o'neil smith.jr", "Mary-Jane O'neil Smith.Jr"),
        ("NATION_0", "Nation_0"),
        ("a/b(c)d&e", "A/B(C)D&E"),
        ("x\ty", "X\tY"),
        ("two  blanks", "Two  Blanks"),
        ("", ""),
        (None, None),
    ],
)
def test_initcap_wide(spark, text, expected):
    assert one(spark, fn.initcap_wide(F.lit(text).cast("string"))) == expected


def test_trim_strips_blanks_only(spark):
    assert one(spark, fn.clean(F.lit("  a\t "))) == "a\t"
    assert one(spark, fn.blank_to_null(F.lit("   "))) is None


@pytest.mark.parametrize(
    "text, expected",
    [("12.345", Decimal("12.35")), ("1234.5", None), ("abc", None), (" 7 ", Decimal("7.00"))],
)
def test_try_number(spark, text, expected):
    assert one(spark, fn.try_number(F.lit(text), 5, 2)) == expected


def test_try_date(spark):
    assert one(spark, fn.try_date(F.lit("2020-13-01"))) is None
    assert one(spark, fn.try_date(F.lit("2020-02-29"))) == date(2020, 2, 29)
    assert one(spark, fn.try_date(F.lit("02012020"), "MMddyyyy")) == date(2020, 2, 1)


def test_money(spark):
    dec = lambda v, t: F.lit(Decimal(v)).cast(t)
    total, zero = dec("10.00", "decimal(18,2)"), dec("0", "decimal(38,0)")
    assert one(spark, fn.unit_price(total, dec("3", "decimal(38,0)"))) == Decimal("3.33333333")
    assert one(spark, fn.unit_price(total, zero)) is None
    assert one(spark, fn.commission(dec("97.73", "decimal(18,2)"), dec("7.50", "decimal(5,2)"))) == Decimal("7.33")
    assert one(spark, fn.commission(total, F.lit(None).cast("decimal(5,2)"))) == Decimal("0.00")
    assert one(spark, fn.safe_divide(F.lit(1.0), F.lit(0))) is None


def test_week_and_parts(spark):
    d = F.lit("2019-12-30").cast("date")
    parts = spark.range(1).select(*[c.alias(n) for n, c in fn.date_parts(d).items()]).first()
    assert tuple(parts) == (2019, 4, 12, "Dec", 1, 30)
    assert one(spark, fn.week_start(F.lit("2021-01-01").cast("date"))) == date(2020, 12, 28)


def test_surrogate_key(spark):
    key = one(spark, fn.surrogate_key(F.lit("a"), F.lit(None).cast("string")))
    assert key == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_").hexdigest()


@pytest.mark.parametrize(
    "name, loose, day, strict",
    [
        ("DailySales_02012020_R001.csv", None, date(2020, 2, 1), "R001"),
        ("DailySales_01052020_RES005.csv", "RES005", date(2020, 1, 5), "RES005"),
        ("dailysales_01052020_res005.CSV", "res005", date(2020, 1, 5), "res005"),
        ("DailySales_02002020_RES010.csv", "RES010", None, "RES010"),
        ("DailySales_01052020_RES005.csv.bak", "RES005", None, None),
        ("Sales_01052020_RES005.csv", None, None, None),
    ],
)
def test_file_names(spark, name, loose, day, strict):
    n = F.lit(name)
    assert one(spark, fn.drop_file_reseller(n, FILE_NAME_LOOSE)) == loose
    assert one(spark, fn.drop_file_date(n)) == day
    assert one(spark, fn.drop_file_reseller(n)) == strict


def test_table_from_file(spark):
    assert one(spark, fn.table_from_file(F.lit("Daily.csv"))) == "DAILY"
