"""Conversation repair against a plain pass over all states."""

import hashlib
import re
import zlib

import numpy as np
import pytest

from daybook.llm import turns
from daybook.operators.segments import Cutting

SCHEMA = "conv_id bigint, turn bigint, role string, text string, digest string, copies int, segment string"
ENDS_WELL = re.compile(r"[.!?][\x20\x09-\x0D]*\Z")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def damage(rows):
    for conv, turn, role, text in rows:
        conv_, turn_, role, text = [" " if x is None else x for x in (conv, turn, role, text)]
        fault = zlib.crc32(f"{conv_}:{turn_}".encode()) % 20
        if fault == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fault, text)
        yield from [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)


def faults(rows):
    seen, found = set(), []
    for role, text in rows:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("" if ENDS_WELL.search(text) else "truncated")
        seen.add((role, text))
    return found


MOVES = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def least(old, new):
    return new if old is None else min(old, new, key=lambda x: x[:2])


def inserted(best):
    for _ in range(3):
        for state, (cost, audit, out) in list(best.items()):
            for role in ("user", "assistant"):
                if to := MOVES[state].get(role[0]):
                    best[to] = least(best.get(to), (cost + 5, audit + "I", (*out, f"{role}:")))
    return best


def repair(rows):
    best = {"": (0, "", ())}
    for (role, text), fault in zip(rows, faults(rows)):
        nxt = {}
        for state, (cost, audit, out) in inserted(best).items():
            nxt[state] = least(nxt.get(state), (cost + 2, audit + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 if fault else 0
            for letter, price, name in (("K", 0, role), ("R", 1, "user"), ("R", 1, "assistant")):
                if to := MOVES[state].get(name[:1]):
                    step = (cost + price + extra, audit + letter, (*out, f"{name}:{text}"))
                    nxt[to] = least(nxt.get(to), step)
        best = nxt
    best = inserted(best)
    return min((best[x] for x in ("", "a") if x in best), key=lambda x: x[:2])


def report(rows):
    """One row per conversation of damaged rows."""
    result = []
    for conv in {row[0] for row in rows}:
        mine = [row[1:] for row in rows if row[0] == conv]
        mine.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], sha(x[2])))
        texts = [row[1:] for row in mine]
        numbers = {row[0] for row in mine if row[0] is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        kinds = faults(texts)
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(texts, texts[1:])]
        cost, audit, out = repair(texts)
        result.append(
            (conv, gaps, *(kinds.count(x) for x in ("blank", "duplicate", "truncated")))
            + (sum(pair not in ("su", "ua", "au") for pair in pairs), cost, audit, sha("\n".join(out)))
        )
    return sorted(result, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", 2, "y") for row in rows], SCHEMA).repartition(3)


def collected(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def random_rows(seed, conversations, longest):
    rng = np.random.default_rng(seed)
    roles = ["user", "assistant", "system", "tool", "", "admin", "us er", None]
    texts = ["Yes.", "no", "", " \t", None, "a! ", "b?\n", "é…", "\U0001d54f."]
    rows = []
    for conv in range(conversations):
        odds = rng.dirichlet(np.ones(len(roles)) * 0.4)
        for turn in range(rng.integers(1, longest)):
            text = str(rng.choice(texts[:5])) if rng.random() < 0.2 else f"{rng.integers(0, 1 + 2 * longest)}{rng.choice(['.', '!', '', '? '])}"
            rows.append((conv, int(turn + rng.integers(0, 2)), roles[rng.choice(len(roles), p=odds)], text))
    return rows


def test_equals_a_plain_pass(spark):
    rows = random_rows(1, 120, 30)
    rows += [(900, None, "user", "x."), (900, None, "assistant", "y."), (900, 3, None, None), (900, 3, "user", "z.")]
    rows += [(None, 1, "assistant", "a."), (None, 2, "user", "b."), (901, None, "user", " ")]
    rows += [(902, 0, "user", "same.")] * 40 + [(902, 1, "assistant", "long " * 20000 + ".")]
    rows = [(conv, turn, role or " ", " " if text is None else text) for conv, turn, role, text in rows]
    assert collected(turns.repair_report(frame(spark, rows))) == report(rows)


def test_long_conversations_in_segments(spark):
    rows = random_rows(2, 3, 20) + [(77, t, r, x) for _, t, r, x in random_rows(3, 60, 30)]
    rows = [(conv, turn, role or " ", " " if text == "None" else text) for conv, turn, role, text in rows]
    cutting = Cutting(sample_rows=2000, sample_rows_per_segment=8, smallest_segment=8)
    parts = turns.segments(frame(spark, rows), cutting)
    assert parts.filter("conv_id = 77").count() > 20
    assert collected(turns.repair_report(frame(spark, rows), cutting=cutting)) == report(rows)


def test_slow_convergence(spark):
    """Equal rows of one role leave no cheap way back to a common vector."""
    rows = [(1, i, "user" if i % 2 else "assistant", f"{i}.") for i in range(90)]
    rows += [(2, i, "assistant" if i % 2 else "user", f"{i}") for i in range(91)]
    cutting = Cutting(sample_rows=4000, sample_rows_per_segment=8, smallest_segment=8)
    assert collected(turns.repair_report(frame(spark, rows), cutting=cutting)) == report(rows)


def test_damage_and_conversations_without_rows(spark):
    rows = [(conv, turn, ("user", "assistant")[turn % 2], f"{turn} said it.") for conv in range(300) for turn in range(3)]
    rows += [(None, None, None, None), (400, None, "user", None)]
    given = frame(spark, rows)
    left = list(damage(rows))
    empty = {conv for conv, *_ in rows} - {conv for conv, *_ in left}
    assert collected(turns.damaged(given)) == sorted(left, key=repr)
    gone = [(conv, 0, 0, 0, 0, 0, 0, "", sha("")) for conv in empty]
    expected = sorted([*report([(c, t, r, x) for c, t, r, x in left]), *gone], key=repr)
    assert collected(turns.repair_report(turns.damaged(given), given)) == expected


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert turns.repair_report(none, none).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_chunks_do_not_matter(seed, monkeypatch):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 60, 20)
    codes = rng.choice(12, sizes.sum(), p=rng.dirichlet(np.ones(12) * 0.3))
    results = []
    for width in (1, 3, 64):
        monkeypatch.setattr(turns, "WIDTH", width)
        lanes = turns.Lanes(codes, sizes, np.tile(turns.END, (20, 1)))
        edits = lanes.edits(np.zeros(20, np.int64))
        results.append([x.tolist() for x in edits] + [lanes.leads().tolist()])
    assert results[0] == results[1] == results[2]
