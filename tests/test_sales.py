import pytest

from daybook.operators import sales
from daybook.sources.sales_files import SALES_SCHEMA

ROWS = [
    ("서울", "전자", 1500, "2024-01"),
    ("서울", "의류", 1200, "2024-02"),
    ("서울", "전자", 300, "2024-02"),
    ("부산", "의류", 800, "2024-01"),
    ("부산", "전자", 800, "2024-04"),
    ("대구", "식품", None, "2024-03"),
    ("부산", "가구", None, "2024-03"),
]


@pytest.fixture(scope="module")
def records(spark):
    return spark.createDataFrame(ROWS, SALES_SCHEMA)


def as_dict(frame, *keys):
    return {
        tuple(row[k] for k in keys): tuple(row[c] for c in frame.columns if c not in keys)
        for row in frame.collect()
    }


def test_by_region(records):
    assert as_dict(sales.sales_by(records, "region"), "region") == {
        ("서울",): (3000.0, 3, 1000.0),
        ("부산",): (1600.0, 2, 800.0),
        ("대구",): (None, 0, None),
    }


def test_subtotals(records):
    cube = as_dict(sales.sales_cube(records), "region", "category")
    assert cube[(None, None)][0] == 4600.0 and cube[(None, "전자")][0] == 2600.0
    assert cube[("서울", None)][0] == 3000.0 and cube[("서울", "전자")][:2] == (1800.0, 2)
    rollup = as_dict(sales.sales_rollup(records), "region", "category")
    assert (None, "전자") not in rollup and rollup[("부산", None)][:2] == (1600.0, 2)


def test_pivot(records):
    wide = sales.sales_pivot(records, ["2024-01", "2024-02", "2024-03", "2024-04"])
    assert as_dict(wide, "region")[("서울",)] == (1500.0, 1500.0, None, None, None)
    narrow = sales.sales_pivot(records, ["2024-02"])
    assert as_dict(narrow, "region")[("부산",)] == (None, 1600.0)


def test_small_and_large_amounts(spark):
    rows = [("a", "x", 0.004, "m"), ("a", "x", 0.004, "m"), ("b", "x", 1e17, "m"), (None, "x", 1.0, "m")]
    frame = spark.createDataFrame(rows, "region string, category string, amount double, month string")
    assert as_dict(sales.sales_by(frame, "region"), "region")[("a",)][0] == 0.008
    cube = as_dict(sales.sales_cube(frame), "region", "category", "level")
    assert cube[(None, "x", 0)][0] == 1.0 and cube[(None, "x", 2)][1] == 4


def test_top_category_takes_the_first_name_on_a_tie(records):
    assert as_dict(sales.top_category(records), "region")[("부산",)] == ("의류", 800.0)
    assert as_dict(sales.top_category(records), "region")[("서울",)] == ("전자", 1800.0)


def test_change_and_share(records):
    change = as_dict(sales.month_change(records), "region", "month")
    assert change[("서울", "2024-02")] == (1500.0, 0.0)
    assert change[("부산", "2024-01")] == (800.0, None)
    assert change[("부산", "2024-03")] == (None, None)
    assert as_dict(sales.region_share(records), "region")[("부산",)] == (1600.0, 1600 / 4600)
