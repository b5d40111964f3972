import json

import pytest
from test_rules import ACCEPTED, ERRORS, REJECTED, raw_rows

from daybook.sources.sales_files import (
    as_accepted,
    read_array_lines,
    read_assigned_array,
    read_csv,
    read_json_array,
    read_raw_records,
    read_rejects,
    sales_rules,
    write_csv,
    write_split,
)

RECORDS = [
    {"region": "north", "category": "rope", "amount": 7, "month": "1999-11"},
    {"region": "섬", "category": "a, [b] {c} = d", "amount": 31, "month": "1999-11"},
    {"region": "south", "category": "tar", "amount": 12, "month": "1999-12"},
]


def array_text(records):
    lines = ",\n".join("    " + json.dumps(record, ensure_ascii=False) for record in records)
    return f"[\n{lines}\n]\n"


def as_set(frame):
    return {tuple(row) for row in frame.select("region", "category", "amount", "month").collect()}


EXPECTED = {(r["region"], r["category"], r["amount"], r["month"]) for r in RECORDS}


@pytest.mark.parametrize(
    "reader, prefix",
    [
        (read_json_array, ""),
        (read_assigned_array, "sales = "),
        (read_assigned_array, ""),
        (read_array_lines, "sales = "),
        (read_array_lines, ""),
    ],
)
def test_array_files(spark, tmp_path, reader, prefix):
    path = tmp_path / "records.json"
    path.write_text(prefix + array_text(RECORDS), encoding="utf-8")
    assert as_set(reader(spark, str(path))) == EXPECTED


def test_records_on_one_line(spark, tmp_path):
    path = tmp_path / "records.json"
    path.write_text("sales = [" + json.dumps(RECORDS[0]) + ",\n" + json.dumps(RECORDS[1]) + "]")
    assert read_assigned_array(spark, str(path)).count() == 2
    assert read_array_lines(spark, str(path)).count() == 2


@pytest.mark.parametrize("reader", [read_json_array, read_assigned_array, read_array_lines])
def test_broken_files_fail(spark, tmp_path, reader):
    path = tmp_path / "records.json"
    path.write_text('[\n{"region": "a", "amount": 1,\n{"region"\n]')
    with pytest.raises(Exception, match="(?i)malformed"):
        reader(spark, str(path)).collect()


def test_several_records_on_a_line(spark, tmp_path):
    path = tmp_path / "records.json"
    path.write_text("sales = [" + ", ".join(map(json.dumps, RECORDS)) + "]")
    assert as_set(read_array_lines(spark, str(path))) == EXPECTED


def test_csv_keeps_odd_cells(spark, tmp_path):
    rows = [
        ("1999-11", "  a ", 1.0, " "),
        ("1999-11", 'say "no", he', 2.0, ""),
        ("1999-12", "b\\c", 3.0, None),
        ("1999-12", "'", 4.0, '"'),
    ]
    frame = spark.createDataFrame(rows, "month string, region string, amount double, category string")
    path = str(tmp_path / "csv")
    write_csv(frame, path)
    assert sorted(map(tuple, read_csv(spark, path).collect()), key=repr) == sorted(rows, key=repr)
    broken = spark.createDataFrame([("a\nb",)], "region string")
    with pytest.raises(Exception, match="line break"):
        write_csv(broken, str(tmp_path / "broken"))


# The text below is a fixed value: what such a file must look like.
def test_csv_text(spark, tmp_path):
    path = str(tmp_path / "csv")
    write_csv(as_accepted(raw_rows(spark, ACCEPTED)).coalesce(1), path)
    (part,) = (tmp_path / "csv").glob("part-*.csv")
    assert part.read_bytes().decode("utf-8") == (
        "month,region,amount,category\r\n"
        "2024-01,서울,1500.0,전자\r\n"
        "2024-01,부산,800.0,의류\r\n"
        "2024-02,대구,2000.0,\r\n"
        "2024-02,인천,500.0,식품\r\n"
    )
    back = read_csv(spark, path).collect()
    assert [tuple(r) for r in back] == [(m, r, float(a), c) for m, r, a, c in ACCEPTED]


def test_write_split(spark, tmp_path):
    good, bad = (str(tmp_path / name) for name in ("good", "bad"))
    write_split(raw_rows(spark, ACCEPTED + REJECTED), sales_rules(), good, bad)
    assert read_csv(spark, good).count() == 4
    back = read_rejects(spark, bad).collect()
    assert {(tuple(r.row), r.error) for r in back} == set(zip(REJECTED, ERRORS))
    lines = [
        json.loads(line)
        for part in (tmp_path / "bad").glob("part-*.json")
        for line in part.read_text(encoding="utf-8").splitlines()
    ]
    without_category = [line["row"] for line in lines if "category" not in line["row"]]
    assert without_category == [{"month": "2024-03", "region": "", "amount": 300}]


def test_raw_records_are_kept(spark, tmp_path):
    path = tmp_path / "records.json"
    path.write_text(
        """sales = [
  {"month": "2024-01", "region": "a", "amount": 10, "category": null},
  {"month": "2024-01", "region": "b", "amount": "much",
   "category": "x"},
  {"month": "2024-01", "region": "", "amount": 5},
  {"month": "2024-01", "region": "", "amount": 6, "category": null}
]""",
        encoding="utf-8",
    )
    rows = read_raw_records(spark, str(path))
    assert rows.count() == 4
    good, bad = (str(tmp_path / name) for name in ("good", "bad"))
    write_split(rows, sales_rules(), good, bad)
    assert [r.region for r in read_csv(spark, good).collect()] == ["a"]
    lines = [
        json.loads(line)
        for part in (tmp_path / "bad").glob("part-*")
        for line in part.read_text(encoding="utf-8").splitlines()
    ]
    assert [line["row"] for line in sorted(lines, key=lambda line: str(line["row"]))] == [
        {"month": "2024-01", "region": "", "amount": 5},
        {"month": "2024-01", "region": "", "amount": 6, "category": None},
        {"month": "2024-01", "region": "b", "amount": "much", "category": "x"},
    ]
    much = [line for line in lines if line["row"]["amount"] == "much"][0]["error"]
    assert "Input should be greater than 0 [type=greater_than" in much


def test_reject_array_file(spark, tmp_path):
    path = tmp_path / "errors.json"
    rows = [
        {"row": {"month": m, "region": r, "amount": a, **({"category": c} if c else {})}, "error": e}
        for (m, r, a, c), e in zip(REJECTED, ERRORS)
    ]
    path.write_text(json.dumps(rows, ensure_ascii=False), encoding="utf-8")
    back = read_rejects(spark, str(path), array_files=True).collect()
    assert [(tuple(r.row), r.error) for r in back] == list(zip(REJECTED, ERRORS))
