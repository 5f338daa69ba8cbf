from pyspark.sql import functions as F

from dialstat.functions import money_sum, money_text, percentage, postcode, predicate


def test_percentage_rounds_half_up(frames):
    df = frames([(50, 64), (75, 100), (60003, 80000), (1, 3)], "s int, m int")
    got = [r[0] for r in df.select(percentage("s", "m")).collect()]
    assert got == [78.13, 75.0, 75.0, 33.33]


def test_percentage_of_zero_calls_is_null_under_ansi(spark, frames):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = frames([(0, 0), (None, 5)], "s int, m int")
    assert [r[0] for r in df.select(percentage("s", "m")).collect()] == [None, None]


def test_money_text_rounds_half_even_and_groups_thousands(frames):
    df = frames([(0.125,), (13444401.05,), (-1234567.5,), (None,)], "x double")
    got = [r[0] for r in df.select(money_text("x")).collect()]
    assert got == ["0.12", "13,444,401.05", "-1,234,567.50", None]


def test_money_sum_is_exact(frames):
    df = frames([(0.1,), (0.2,), (None,)], "x double")
    total = df.agg(money_sum("x").alias("t")).first()["t"]
    assert str(total) == "0.3000000000"


def test_postcode_cases(frames):
    df = frames(
        [("Jetlaan 1, 8779 EM, X",), ("8779EM",), ("8779 em",), ("no code",), (None,)],
        "address string",
    )
    got = [r[0] for r in df.select(postcode("address")).collect()]
    assert got == ["8779 EM", "8779EM", "", "", None]


def test_predicate_from_sql_text_and_column(frames):
    df = frames([(-1.0,), (2.0,), (None,)], "sales_amount double")
    assert df.filter(predicate("sales_amount < 0")).count() == 1
    assert df.filter(predicate(F.col("sales_amount") > 0)).count() == 1


def test_percentage_does_not_overflow_int_counts(frames):
    df = frames([(2_000_000_000, 2_100_000_000)], "s int, m int")
    assert df.select(percentage("s", "m")).first()[0] == 95.24
