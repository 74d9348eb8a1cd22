from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orrery.functions import rules
from orrery.functions.calendar import calendar_columns
from orrery.functions.display import pretty_size
from orrery.functions.money import line_amount, mean_from_total

EXAMPLES = [
    ("2025-09-08", "en", 20250908, "2025-Q3", "September", "2025-09", 37, "2025-W37", 1, "Monday", False),
    ("2023-01-01", "en", 20230101, "2023-Q1", "January", "2023-01", 52, "2022-W52", 7, "Sunday", True),
    ("2024-12-30", "en", 20241230, "2024-Q4", "December", "2024-12", 1, "2025-W01", 1, "Monday", False),
    ("2025-09-08", "fr", 20250908, "2025-T3", "septembre", "2025-09", 37, "2025-S37", 1, "lundi", False),
    ("2023-01-01", "fr", 20230101, "2023-T1", "janvier", "2023-01", 52, "2022-S52", 7, "dimanche", True),
    ("2024-12-30", "fr", 20241230, "2024-T4", "décembre", "2024-12", 1, "2025-S01", 1, "lundi", False),
]


@pytest.mark.parametrize("day,lang,key,quarter,month,ym,week,yw,dow,name,weekend", EXAMPLES)
def test_calendar_examples(spark, day, lang, key, quarter, month, ym, week, yw, dow, name, weekend):
    row = (
        spark.range(1)
        .select(F.to_date(F.lit(day)).alias("d"))
        .select(*calendar_columns(F.col("d"), lang))
        .first()
    )
    assert (row.date_key, row.quarter_label, row.month_name, row.year_month) == (
        key, quarter, month, ym,
    )
    assert (row.week_of_year, row.year_week, row.day_of_week, row.day_name, row.is_weekend) == (
        week, yw, dow, name, weekend,
    )


def test_unknown_language_is_refused():
    with pytest.raises(ValueError, match="unknown language"):
        calendar_columns(F.col("d"), "de")


@pytest.mark.parametrize(
    "total,n,mean",
    [
        ("0.01", 2, "0.01"), ("0.01", 3, "0.00"), ("-0.01", 2, "-0.01"), ("2.00", 3, "0.67"),
        ("10.05", 2, "5.03"), ("-10.05", 2, "-5.03"), ("99999999999999999.99", 1000000, "100000000000.00"),
    ],
)
def test_mean_rounds_once_half_away_from_zero(spark, total, n, mean):
    row = spark.range(1).select(
        mean_from_total(F.lit(Decimal(total)).cast("decimal(38,2)"), F.lit(n).cast("long"))
    )
    assert row.first()[0] == Decimal(mean)


def test_amount_overflow_is_an_error(spark):
    price = F.lit(Decimal("9999999999.99"))
    with pytest.raises(Exception, match="(?i)out of range|cannot be represented"):
        spark.range(1).select(line_amount(F.lit(2_000_000), price)).collect()


@pytest.mark.parametrize(
    "size,text",
    [
        (0, "0 bytes"), (10239, "10239 bytes"), (10240, "10 kB"), (10751, "10 kB"),
        (10752, "11 kB"), (10485247, "10239 kB"), (10485248, "10 MB"), (256901120, "245 MB"),
        (1 << 40, "1024 GB"), (20 << 40, "20 TB"),
    ],
)
def test_pretty_size(spark, size, text):
    assert spark.range(1).select(pretty_size(F.lit(size))).first()[0] == text


def test_rules(spark):
    row = (
        spark.createDataFrame([(2025, 3, None, "abcdef")], "y int, q int, n string, t string")
        .select(
            rules.fill_template("%y%-Q%q%", y=F.col("y"), q=F.col("q")).alias("label"),
            rules.default_if_absent(F.col("n"), "x").alias("filled"),
            rules.default_if_absent(F.col("t"), "x").alias("kept"),
            rules.branch_on_value(F.col("n"), {"a": 1}, default=2, when_null=3).alias("null_case"),
            rules.branch_on_value(F.col("q"), {3: "three"}, default="other").alias("hit"),
            rules.branch_on_expressions([(F.col("q") > 5, "big")], "small").alias("expr"),
            rules.slice_text(F.col("t"), 1, 3).alias("cut"),
            rules.numbered_code("C", F.lit(1234567), 6).alias("long_code"),
        )
        .first()
    )
    assert tuple(row) == ("2025-Q3", "x", "abcdef", 3, "three", "small", "bc", "C1234567")
    with pytest.raises(ValueError, match="unknown value"):
        rules.fill_template("%a%", b=F.lit(1))
