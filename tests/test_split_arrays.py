"""Array files read by byte ranges."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daybook.sources.sales_files import SALES_SCHEMA, read_json_array
from daybook.sources.split_arrays import (
    array_records,
    range_states,
    read_split_array,
    read_split_raw_records,
)
from daybook.sources import split_arrays

ODD = ['a "q" \\', "{[", "]}", "}", '"}', "\\\\\"", "섬 {", "", "x, {\"region\": \"y\"}", "\\"]


def records(count):
    return [
        {"region": ODD[i % len(ODD)] * (i % 4), "category": f"{i}", "amount": i, "month": ODD[(i * 7) % len(ODD)]}
        for i in range(count)
    ]


def text_of(rows, prefix="", indent=None, ascii_only=False):
    return prefix + json.dumps(rows, ensure_ascii=ascii_only, indent=indent)


def as_rows(df):
    return sorted(tuple(row) for row in df.select("region", "category", "amount", "month").collect())


def expected(rows):
    return sorted((r["region"], r["category"], r["amount"], r["month"]) for r in rows)


@pytest.mark.parametrize("range_bytes", [60, 1000])
@pytest.mark.parametrize("prefix, indent", [("", None), ("sales = ", None), ("\n sales_1=", 2)])
def test_ranges_do_not_matter(spark, tmp_path, range_bytes, prefix, indent):
    rows = records(30)
    path = tmp_path / "rows.json"
    path.write_text(text_of(rows, prefix, indent), encoding="utf-8")
    assert as_rows(read_split_array(spark, str(path), SALES_SCHEMA, range_bytes)) == expected(rows)


def test_equals_the_whole_file_reader_and_uses_many_tasks(spark, tmp_path):
    rows = records(5000)
    path = tmp_path / "rows.json"
    path.write_text(text_of(rows), encoding="utf-8")
    found = read_split_array(spark, str(path), SALES_SCHEMA, 10_000)
    assert as_rows(found) == as_rows(read_json_array(spark, str(path)))
    pieces = split_arrays._pieces(split_arrays.pinned_session(spark, 10_000), str(path))
    assert pieces.rdd.getNumPartitions() > 8
    states = range_states(spark, pieces)
    assert states.count() > 8 and states.filter("depth > 1 OR in_string = 1").count() > 0


def test_nested_values_and_own_text(spark, tmp_path):
    rows = [{"a": {"b": [{"c": "}"}, {}]}, "d": []}, {}, {"a": {"b": []}, "d": [{"e": "]"}]}]
    path = tmp_path / "rows.json"
    path.write_text(text_of(rows))
    texts = [row.raw for row in array_records(spark, str(path), 5).collect()]
    assert sorted(texts) == sorted(json.dumps(row) for row in rows)


def test_one_record_over_many_ranges(spark, tmp_path):
    rows = [{"region": "x{" * 3000, "category": "}" * 500, "amount": 1, "month": "m"}] + records(3)
    path = tmp_path / "rows.json"
    path.write_text(text_of(rows))
    assert as_rows(read_split_array(spark, str(path), SALES_SCHEMA, 400)) == expected(rows)


def test_several_files_some_empty(spark, tmp_path):
    for name, text in (("a", "[]"), ("b", " x = [ ]\n"), ("c", ""), ("d", text_of(records(9))), ("e", text_of(records(4), "s = "))):
        (tmp_path / f"{name}.json").write_text(text)
    found = read_split_array(spark, str(tmp_path), SALES_SCHEMA, 30)
    assert as_rows(found) == expected(records(9) + records(4))


def test_wrong_kinds_become_null_with_their_text(spark, tmp_path):
    path = tmp_path / "rows.json"
    path.write_text('[{"region": "a", "amount": "x"}, {"region": "b"}]')
    rows = read_split_raw_records(spark, str(path), SALES_SCHEMA, 10).collect()
    assert sorted((r.region or "", r.amount, r.raw) for r in rows) == [
        ("a", None, '{"region": "a", "amount": "x"}'),
        ("b", None, '{"region": "b"}'),
    ]


@pytest.mark.parametrize(
    "text",
    [
        '[{"amount": 1}, {"amount": 2',
        '[{"amount": 1}, {"amount": 2}',
        '[{"amount": 1} {"amount": 2}]',
        '[{"amount": 1}, 5]',
        '{"amount": 1}',
        '[{"amount": 1}, {"amount": "x]',
        '[{"amount": "word"}]',
        'x [{"amount": 1}]',
        '[{"amount": 1}]]',
    ],
)
def test_broken_files_fail(spark, tmp_path, text):
    path = tmp_path / "rows.json"
    path.write_text(text)
    with pytest.raises(Exception, match="(?i)malformed"):
        read_split_array(spark, str(path), SALES_SCHEMA, 6).collect()


JSON = st.recursive(
    st.none() | st.integers(-5, 5) | st.text('a"\\{}[],: é\n', max_size=6),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text('a"\\{}[]', max_size=3), inner, max_size=3),
    max_leaves=6,
)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dictionaries(st.text('k"\\}', max_size=3), JSON, max_size=3), max_size=8), st.integers(9, 60))
def test_any_records(spark, tmp_path_factory, rows, range_bytes):
    path = tmp_path_factory.mktemp("any") / "rows.json"
    path.write_text(text_of(rows), encoding="utf-8")
    texts = [row.raw for row in array_records(spark, str(path), range_bytes).collect()]
    assert sorted(texts) == sorted(json.dumps(row, ensure_ascii=False) for row in rows)
