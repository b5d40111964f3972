from urllib.parse import urlencode

import pytest

from daybook.operators import forms, rules
from daybook.sources.query_strings import param_rows

GOOD = [
    ("userId", "abcd"),
    ("userPw", "12345678"),
    ("userEmail", "a"),
    ("emailDomain", "naver.com"),
    ("userName", "홍 길동"),
    ("userBirth", "2001-02-28"),
    ("gender", "female"),
    ("interest", "uiux"),
    ("interest", "backend"),
    ("joinPath", "sns"),
    ("intro", "hello"),
]


def sent(spark, *pairs_list):
    urls = [(i, "signUpResult.html?" + urlencode(pairs)) for i, pairs in enumerate(pairs_list)]
    return forms.read_submissions(spark.createDataFrame(urls, "id int, url string"), "url")


def changed(**values):
    kept = [(k, values.get(k, v)) for k, v in GOOD if values.get(k, v) is not None]
    return kept + [(k, v) for k, v in values.items() if k not in dict(GOOD)]


def violations(spark, *pairs_list):
    bad = rules.rejected(sent(spark, *pairs_list), forms.form_rules())
    found = {}
    for row in rules.violation_rows(bad, ["id"]).collect():
        found.setdefault(row.id, []).append((row.field, row.type))
    return [found.get(i, []) for i in range(len(pairs_list))]


def test_fields(spark):
    row = sent(spark, GOOD).first()
    assert row.userId == "abcd" and row.userPw_len == 8 and row.userName == "홍 길동"
    assert str(row.userBirth) == "2001-02-28"
    assert row.interest == ["uiux", "backend"]
    assert row.joinPath == "sns"
    assert "userPw" not in row.asDict() and "12345678" not in str(row)
    bare = sent(spark, [("userId", "abcd"), ("userBirth", "")]).first()
    assert bare.interest == [] and bare.joinPath is None and bare.gender == "male"
    assert bare.userBirth is None and bare.intro is None


def test_rules(spark):
    cases = {
        "good": (GOOD, []),
        "id 3": (changed(userId="abc"), [("userId", "length")]),
        "id 15": (changed(userId="a" * 15), []),
        "id 16": (changed(userId="a" * 16), [("userId", "length")]),
        "id blank": (changed(userId=""), [("userId", "required")]),
        "id missing": (changed(userId=None), [("userId", "required")]),
        "id symbols": (changed(userId="!?* "), []),
        "id wide": (changed(userId="🌀🌀"), []),
        "pw 7": (changed(userPw="1234567"), [("userPw_len", "length")]),
        "pw blank": (changed(userPw=""), [("userPw_len", "required")]),
        "pw missing": (changed(userPw=None), [("userPw_len", "required")]),
        "name missing": (changed(userName=None), [("userName", "required")]),
        "domain": (changed(emailDomain="x.example"), [("emailDomain", "choice")]),
        "domain missing": (changed(emailDomain=None), []),
        "birth": (changed(userBirth="2001-02-30"), [("userBirth_text", "date")]),
        "birth format": (changed(userBirth="28.02.2001"), [("userBirth_text", "date")]),
        "birth blank": (changed(userBirth=""), []),
        "gender": (changed(gender="x"), [("gender", "choice")]),
        "gender missing": (changed(gender=None), []),
        "path": (changed(joinPath="tv"), [("joinPath", "choice")]),
        "path missing": (changed(joinPath=None), []),
        "interest": (GOOD + [("interest", "chess")], [("interest", "choice")]),
        "intro 200": (changed(intro="가" * 200), []),
        "intro 201": (changed(intro="가" * 201), [("intro", "length")]),
        "intro breaks": (changed(intro="a\r\n" * 100), []),
        "several": (
            changed(userId="a", userPw="1", gender="x"),
            [("userId", "length"), ("userPw_len", "length"), ("gender", "choice")],
        ),
    }
    found = violations(spark, *[pairs for pairs, _ in cases.values()])
    assert dict(zip(cases, found)) == {name: wanted for name, (_, wanted) in cases.items()}


@pytest.mark.parametrize(
    "url, expected",
    [
        ("a.html?x=1&y=a+b&x=2#z?q=1", [("x", "1"), ("y", "a b"), ("x", "2")]),
        ("a.html?name=%ED%97%88", [("name", "허")]),
        ("a.html?bad=%ZZ&ok=1", [("bad", None), ("ok", "1")]),
        ("a.html?flag&empty=&=v&eq=a=b", [("flag", ""), ("empty", ""), ("", "v"), ("eq", "a=b")]),
        ("a.html?&&a=1&", [("a", "1")]),
        ("a.html#x?y=1", []),
        ("a.html", []),
        ("a.html?q=a b|c", [("q", "a b|c")]),
    ],
)
def test_param_rows(spark, url, expected):
    rows = param_rows(spark.createDataFrame([(1, url)], "id int, url string"), "id", "url")
    assert [(r.key, r.value) for r in rows.orderBy("pos").collect()] == expected
