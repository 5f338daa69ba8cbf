import pytest
from pyspark.sql import functions as F

from dialstat.operators import Gate, GateError, check, duplicate_keys, require_non_empty, violation_counts


def test_empty_result_fails(frames):
    empty = frames([], "id int")
    with pytest.raises(GateError, match="no rows"):
        check(empty, Gate())
    with pytest.raises(GateError):
        require_non_empty(empty)


def test_negative_fails_null_passes(frames):
    df = frames([(1, 5.0), (2, None)], "id int, sales_amount double")
    assert check(df, Gate(bad={"neg": "sales_amount < 0"}))["rows"] == 2
    bad = frames([(1, -5.0), (2, None)], "id int, sales_amount double")
    with pytest.raises(GateError, match="1 rows with neg"):
        check(bad, Gate(bad={"neg": "sales_amount < 0"}))


def test_duplicate_key_fails(frames):
    df = frames([(1, "a"), (1, "b"), (2, "a")], "id int, area string")
    with pytest.raises(GateError, match="duplicate keys on \\['id'\\]"):
        check(df, Gate(unique=[["id"]]))
    assert check(df, Gate(unique=[["id", "area"]]))["rows"] == 3
    dups = duplicate_keys(df, ["id"]).collect()
    assert [(r["id"], r["count"]) for r in dups] == [(1, 2)]


def test_all_failures_reported_together(frames):
    df = frames([(1, -1.0), (1, -2.0)], "id int, x double")
    with pytest.raises(GateError) as err:
        check(df, Gate(bad={"neg": F.col("x") < 0}, unique=[["id"]]))
    assert "2 rows with neg" in str(err.value) and "duplicate" in str(err.value)


def test_violation_counts_one_row(frames):
    df = frames([(1, -1.0), (2, 3.0), (3, None)], "id int, x double")
    row = violation_counts(df, {"neg": "x < 0", "missing": "x IS NULL"}).first()
    assert (row["rows_checked"], row["neg"], row["missing"]) == (3, 1, 1)
