"""Ranked search against plain scoring of every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from daybook.llm import lexical

DOCS = "doc_id bigint, text string, item_id string, score int, terms string"
ITEMS = "item_id bigint, text string, doc_id string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected(docs, items, k):
    held = [(doc, Counter(terms(text)), len(terms(text))) for doc, text in docs]
    held = [row for row in held if row[2]]
    documents, total = len(held), sum(row[2] for row in held)
    df = Counter(term for _, counts, _ in held for term in counts)
    rows = []
    for item, text in set(items):
        scored = []
        for doc, counts, n in held:
            m = 25 + 75 * n * documents // total
            score = 0
            for term in terms(text):
                if tf := counts[term]:
                    w = math.floor(1000 * math.log((2 * documents + 2) / (2 * df[term] + 1)))
                    score += w * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1):
            rows.append((item, rank, doc, -score))
    return sorted(rows, key=repr)


def found(spark, docs, items, **options):
    left = spark.createDataFrame([(*row, "x", 1, "y") for row in docs], DOCS).repartition(3)
    right = spark.createDataFrame([(*row, "z") for row in items], ITEMS)
    return sorted((tuple(row) for row in lexical.ranked(left, right, **options).collect()), key=repr)


LETTERS = np.array(list("abcdefghijklmnopqrstuvwxyzé\U0001d54f"))


def corpus(seed, count):
    rng = np.random.default_rng(seed)
    words = ["".join(rng.choice(LETTERS, rng.integers(1, 4))) for _ in range(120)]
    odds = 1 / np.arange(1, 121)
    docs = []
    for i in range(count):
        chosen = rng.choice(words, rng.integers(0, 60), p=odds / odds.sum())
        docs.append((int(i * 7 % count), " ".join(chosen).title() if i % 3 else "-".join(chosen)))
    items = [(i, " ".join(rng.choice(words, 12))) for i in range(9)]
    return docs, items


def test_equals_plain_scores(spark):
    docs, items = corpus(3, 400)
    docs += [(5, docs[5][1]), (None, docs[6][1]), (None, None), (401, ""), (402, "... !"), (403, "é" * 3000)]
    docs += [(500 + i, docs[8][1]) for i in range(60)]
    items += [(1, items[1][1]), (2, "another text of é"), (None, docs[9][1]), (50, None), (51, " - ")]
    assert found(spark, docs, items) == expected(docs, items, 10)


def test_blocks_and_shards_do_not_matter(spark, monkeypatch):
    docs, items = corpus(4, 150)
    monkeypatch.setattr(lexical, "SHARD", 40)
    monkeypatch.setattr(lexical, "LEAF", 2)
    assert found(spark, docs, items, k=3, block_items=2, block_pairs=30) == expected(docs, items, 3)


def test_empty_tables(spark):
    docs, items = corpus(5, 10)
    assert found(spark, [], items) == found(spark, docs, []) == found(spark, [(1, None)], items) == []


def test_long_texts_are_read_whole(monkeypatch):
    monkeypatch.setattr(lexical, "PIECE", 10)
    text = "Alpha beta, é1 " * 50 + "x" * 45
    assert lexical.count_terms(text.encode()) == Counter(x.encode() for x in terms(text))


@settings(max_examples=60, deadline=None)
@given(st.data())
def test_search_equals_all_scores(data):
    docs, lists = data.draw(st.integers(1, 80)), data.draw(st.integers(1, 5))
    rng = np.random.default_rng(data.draw(st.integers(0, 10**6)))
    held = np.flatnonzero(rng.random(docs * lists) < data.draw(st.floats(0, 1)))
    owner, place = np.divmod(held, docs)
    impacts = rng.integers(0, data.draw(st.sampled_from([2, 1000])), len(held))
    shuffled = rng.permutation(len(held))
    shard = lexical.Shard(owner[shuffled], place[shuffled], impacts[shuffled], docs)
    times = rng.integers(1, 3, lists)
    best = lexical.Best(4)
    ids = np.arange(docs) * 2
    lexical.search(shard, np.arange(lists), times, ids, np.zeros(docs, bool), best)
    total = np.zeros(docs, np.int64)
    np.add.at(total, place, impacts * times[owner])
    order = [i for i in np.lexsort((ids, -total)) if total[i] > 0][:4]
    assert best.ids.tolist() == ids[order].tolist()
    assert best.scores.tolist() == total[order].tolist()


def test_bounds_hold(spark):
    rng = np.random.default_rng(1)
    owner, place = np.divmod(np.arange(300), 100)
    shard = lexical.Shard(owner, place, rng.integers(1, 50, 300), 100)
    terms_, times = np.arange(3), np.array([1, 2, 1])
    for low in range(0, 100, 7):
        for high in range(low + 1, 101, 9):
            reach, split = shard.bounds(terms_, times, np.array([low]), np.array([high]))
            docs, scores = shard.scores(terms_, times, np.array([low]), np.array([high]))
            tops = [shard.impacts[t * 100 + low : t * 100 + high].max() * times[t] for t in range(3)]
            assert reach[0] == sum(tops) >= scores.max()
            assert low <= split[0] < high and pytest.approx(max(tops)) in [
                shard.impacts[t * 100 + split[0]] * times[t] for t in range(3)
            ]
