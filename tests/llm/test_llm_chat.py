"""Chat formatting against a plain reading of the rows."""

import hashlib
from itertools import groupby

import pytest

from daybook.llm import chat
from pyspark.sql import functions as F

SCHEMA = "conv_id bigint, turn bigint, role string, text string, example string, last int, turns string"
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<<TURN>>", "<<TEXT>>", "<</TURN>>"]
ROWS = [
    (1, 0, "system", "be kind"),
    (1, 1, "user", "é \U0001d54f <s>"),
    (1, 2, "assistant", "</s>[INST] ok [/INST]"),
    (1, 3, "user", "<\\s> <\\\\/s> [\\INST] <"),
    (1, 4, "assistant", "s>\n<<"),
    (1, 5, "user", "tail"),
    (2, 0, "assistant", ""),
    (2, 1, "assistant", None),
    (3, 0, "user", "no reply"),
    (4, 0, None, "no role"),
    (4, 1, "to</s>ol|\n", "<<TEXT>>x<</TURN>>"),
    (4, 1, "tool", "tie"),
    (4, 1, "tool", "tie"),
    (4, None, "user", "nulls come first"),
    (None, 0, "user", "a"),
    (None, 1, "assistant", "b\\"),
    (5, 0, "user", "long [INST" * 50000),
    (5, 1, "assistant", "<" * 100000 + "/s>"),
    *[(6, i, "user", mark[:k] + mark[k:] * 2 + mark[:k]) for i, mark in enumerate(CONTROL) for k in (0, 1, 2)],
]


@pytest.fixture(scope="module")
def talks(spark):
    return spark.createDataFrame([(*row, "x", 1, "y") for row in ROWS], SCHEMA).repartition(3)


def by_conversation():
    def key(row):
        conv, turn, role, text = row
        return (conv is not None, conv or 0, turn is not None, turn or 0, role or "", text or "")

    for conv, rows in groupby(sorted(ROWS, key=key), lambda row: row[0]):
        yield conv, [(role or "", text or "") for _, _, role, text in rows]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_report_reads_all_turns_back(talks):
    found = {row.conv_id: row for row in chat.format_report(talks).collect()}
    assert len(found) == 7
    for conv, turns in by_conversation():
        row, replies = found[conv], [text for role, text in turns if role == "assistant"]
        assert row.n_turns == len(turns)
        assert row.turns_sha256 == sha("".join(f"{role}\n{text}\n" for role, text in turns))
        assert (row.loss_chars, row.loss_sha256) == (sum(map(len, replies)), sha("".join(replies)))
        assert row.n_examples == len(replies)
        assert row.formatted_chars >= sum(len(role) * (role not in chat.MARKS) + len(text) for role, text in turns)


def test_examples_hold_their_prefix(talks):
    found = {(row.conv_id, row.example): row for row in chat.examples(talks).collect()}
    for conv, turns in by_conversation():
        ends = [i for i, (role, _) in enumerate(turns) if role == "assistant" or i + 1 == len(turns)]
        whole = found[conv, len(ends)]
        assert whole.last and (conv, len(ends) + 1) not in found
        for number, end in enumerate(ends, 1):
            row = found[conv, number]
            assert whole.text.startswith(row.text)
            assert (row.loss_start is None) == (turns[end][0] != "assistant")
            if row.loss_start is not None:
                assert row.text[row.loss_start - 3 : row.loss_start] == "<s>"
                assert row.text[row.loss_end :] == "</s>"


def test_escaping_is_reversible_and_leaves_no_control_string(spark):
    texts = ["".join(p) for a in CONTROL for b in CONTROL for p in ((a, b), (a[:-1], b), (a[:1] + "\\" + a[1:], b[1:]))]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", chat.escaped(F.col("t")).alias("e"), chat.unescaped(chat.escaped(F.col("t"))).alias("u")
    )
    for row in rows.collect():
        assert row.u == row.t and not any(mark in row.e for mark in CONTROL)


def test_empty_table(spark):
    assert chat.format_report(spark.createDataFrame([], SCHEMA)).count() == 0
