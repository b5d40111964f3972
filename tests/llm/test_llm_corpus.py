"""Operators that compare documents, vectors or pages, against plain counterparts."""

import functools
import math
import random
import re
import time

import brute
import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F
from odd_texts import LONG, TEXTS, rows_of

from daybook.llm import bands, disclosure, simhash, suffixes, top_k, wrappers
from daybook.llm.links import components

SPANS = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"]


def test_personal_data(docs, no_docs):
    expected = sorted(((i, *brute.personal(text)) for i, text, _, _ in TEXTS), key=repr)
    assert rows_of(disclosure.personal_data_report(docs), *SPANS) == expected
    assert disclosure.personal_data_report(no_docs).count() == 0


def test_disclosing_terms(spark):
    rows = [(i, f"note {i} from Zorblatt about x@mail.org today") for i in range(4)]
    rows += [(10 + i, f"the note number {i} about nothing from here today") for i in range(40)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    spans = {row.doc_id: row.spans for row in disclosure.personal_data_report(table).collect()}
    kinds = {span.split(":")[0] for span in spans[0].split(",")}
    assert kinds == {"email", "removed"}
    assert spans[12] == ""
    texts = {row.doc_id: row.text for row in disclosure.sanitised(table).collect()}
    assert texts[0] == "note 0 from  about [EMAIL] today"
    assert texts[12] == rows[6][1]


def plain_disclosure(rows, evidence=3, generalise=0.85, remove=0.95):
    """All spans of texts that are unlike each other, pair by pair."""
    word = re.compile(r"[^\W\d_]+")
    names = [kind for kind, *_ in brute.PERSONAL]
    held, entities, outside = [], [], []
    for _, text in rows:
        spans = brute._kinds(text or "", brute.PERSONAL)
        free = [m.span() for m in word.finditer(text or "") if not any(a < m.end() and m.start() < b for a, _, _, b in spans)]
        outside.append([(a, b, text[a:b].lower()) for a, b in free])
        entities.append({(kind, text[a:b].lower()) for a, _, kind, b in spans})
        held.append({m.lower() for m in word.findall(text or "")})
    shares = {}
    for entity in set().union(*entities):
        mine = [i for i, found in enumerate(entities) if entity in found]
        bits = math.log2(len(rows) / len(mine))
        for term in {t for i in mine for *_, t in outside[i]}:
            both = sum(any(t == term for *_, t in outside[i]) for i in mine)
            n = sum(term in x for x in held)
            if both >= evidence and bits > 0:
                shares[term] = max(shares.get(term, 0), math.log2(both * len(rows) / n / len(mine)) / bits)
    result = {}
    for (i, text), places in zip(rows, outside):
        spans = [(a, p, b) for a, p, _, b in brute._kinds(text or "", brute.PERSONAL)]
        spans += [(a, len(names) + (shares[t] >= remove), b) for a, b, t in places if shares.get(t, 0) >= generalise]
        kinds = [*names, "term", "removed"]
        result[i] = ",".join(f"{kinds[p]}:{a}:{b}" for a, p, b in sorted(spans))
    return result


def test_terms_disclose_at_any_distance(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghijklm", k=4)) for _ in range(300)]

    def some(count):
        return " ".join(rng.choices(words, k=count))

    rows = [(i, f"Zorblatt {some(30)} mail x@mail.org now {some(9)} zorblatt") for i in range(6)]
    rows += [(10 + i, f"{some(25)} Quux{'!' * i} {some(20)} 10.0.0.{1 + i % 2} {some(4)}") for i in range(12)]
    rows += [(40 + i, f"now {some(40)} mail") for i in range(60)]
    rows += [(200, f"Zorblatt alone {some(20)}"), (201, None), (202, f"{some(30)} a@b.cd, a@b.cd Quux")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = {row.doc_id: row.spans for row in disclosure.personal_data_report(table).collect()}
    assert found == plain_disclosure(rows)
    assert all(found[i].count("removed") + found[i].count("term") == 2 for i in range(6))
    assert "0:8" in found[200]


def test_near_copies_are_one_piece_of_evidence(spark):
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefghijklm", k=6)) for _ in range(4000)]
    story = rng.sample(words, 80)
    rows = [(i, " ".join([*story, f"word{i}", "to z@mail.org"])) for i in range(20)]
    rows += [(100 + i, " ".join(rng.choices(words, k=30))) for i in range(50)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {row.doc_id: row.spans for row in disclosure.personal_data_report(table).collect()}
    assert all(span.startswith("email") for i in range(20) for span in found[i].split(","))


def test_fingerprints_and_groups(docs, no_docs):
    prints = [brute.simhash(text) for _, text, _, _ in TEXTS]
    label = brute.components(len(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    ids = [i for i, _, _, _ in TEXTS]
    least = {
        root: min((ids[k] for k in range(len(ids)) if label[k] == root and ids[k] is not None), default=None)
        for root in set(label)
    }
    expected = sorted(
        ((i, f"{p:016x}", least[root]) for i, p, root in zip(ids, prints, label)), key=repr
    )
    for slice_size in (1, simhash.SLICE):
        found = simhash.near_duplicates(docs, slice_size=slice_size)
        assert rows_of(found, "doc_id", "fingerprint", "component_id") == expected
    assert simhash.near_duplicates(no_docs).count() == 0


def test_bit_sliced_comparison():
    random.seed(3)
    base = [random.getrandbits(64) for _ in range(40)]
    near = [x ^ (1 << random.randrange(64)) ^ (1 << random.randrange(64)) for x in base * 5]
    prints = np.unique(np.array(base + near, np.uint64))
    for radius in (1, 2, 3, 24):
        found = set()
        for one, other in simhash.near_pairs(np.zeros(len(prints), int), prints, radius):
            found |= set(zip(one.tolist(), other.tolist()))
        expected = {
            (a, b)
            for b in range(len(prints))
            for a in range(b)
            if (int(prints[a]) ^ int(prints[b])).bit_count() <= radius
        }
        assert found == expected


def test_hot_buckets_lose_no_link(spark):
    random.seed(5)
    base = random.getrandbits(63)
    prints = {base}
    while len(prints) < 120:
        prints.add(random.choice(sorted(prints)) ^ (1 << random.randrange(40)))
    table = spark.createDataFrame([(x,) for x in prints], "print bigint")
    for slice_size in (4, 4096):
        roots = components(simhash.near_links(table, slice_size)).select("root").distinct()
        assert roots.count() == 1


def test_components_of_a_chain_and_no_links(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(99, 98), (7, 7)], "a bigint, b bigint")
    found = dict(components(chain).collect())
    assert {found[i] for i in range(61)} == {0}
    assert found[99] == found[98] == 98
    assert components(chain.limit(0)).count() == 0


def test_one_of_each_component_stays(spark, docs, no_docs):
    prints = [brute.simhash(text) for _, text, _, _ in TEXTS]
    label = brute.components(len(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    ids = [i for i, _, _, _ in TEXTS]
    expected = [min((ids[k] for k in range(len(ids)) if label[k] == root and ids[k] is not None), default=None) for root in set(label)]
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted([row.doc_id for row in kept.collect()], key=repr) == sorted(expected, key=repr)
    assert simhash.keep_one(no_docs).count() == 0
    # Names like those used within, rows that differ in other columns only, and no id at all.
    rows = [(None, "a b c d", 2, 0, 0), (None, "a b c d", 1, 0, 0), (5, "x y z u", 1, 0, 0), (5, "x y z u", 2, 0, 0)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, hash int, print int, root int")
    first = simhash.keep_one(table).collect()
    assert sorted((row.doc_id or 0) for row in first) == [0, 5]
    again = simhash.keep_one(table.orderBy(F.col("hash").desc())).collect()
    assert sorted(first, key=repr) == sorted(again, key=repr)


def test_repeats_with_clashing_names(spark):
    story = "The same long passage stands in two of the documents, word by word and to its end."
    rows = [(1, f"One. {story}", 7, "a"), (2, f"Two. {story}", 8, "b"), (3, None, 9, "c")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, _null_text int, rest string")
    kept = {row.doc_id: (row.text, row._null_text, row.rest) for row in suffixes.without_repeats(table).collect()}
    assert kept[1] == (f"One. {story}", 7, "a") and kept[3] == (None, 9, "c")
    assert kept[2][0].startswith("Two") and len(kept[2][0]) < 10 and kept[2][1:] == (8, "b")


def test_messages_grow_with_the_input():
    """Names of a chunk for as many buckets as 0.2 GB, 1 TB and 100 TB have."""
    assert suffixes.sizes_for(10**14) == (4 * suffixes.CHUNK, 2 * suffixes.BUCKET)
    text = " ".join(f"w{i * 7919 % 100003}" for i in range(400_000)).encode()
    row = {"texts": zstandard.compress(text), "sizes": [len(text)], "ids": [1]}

    def sent(total):
        chunk, bucket = suffixes.sizes_for(total)
        whole = suffixes.Chunk(row, -(-total // bucket))
        messages = list(whole.sent_names())
        assert sum(len(suffixes.unpacked(x[1], np.uint64)) for x in messages) == len(whole.names)
        size = sum(sum(map(len, x[1:])) for x in messages)
        return size / len(whole.names)

    assert suffixes.sizes_for(0) == suffixes.sizes_for(1 << 30) == (suffixes.CHUNK, suffixes.BUCKET)
    small, large, huge = sent(2 * 10**8), sent(10**12), sent(10**14)
    assert large < 4 * small and huge < 8 * small


def test_similar_texts_share_a_band():
    words = [f"w{i}" for i in range(200)]
    whole, most, other = (set(bands.bands(" ".join(x))) for x in (words, words[:190], words[::-1]))
    assert whole & most and not whole & other
    assert bands.bands(None) == bands.bands(" \n") == [] and len(bands.bands("one")) == bands.BANDS


@pytest.mark.parametrize("sizes", [{}, {"chunk_size": 500, "bucket_size": 500, "hot": 2}])
def test_repeated_passages(docs, no_docs, sizes):
    expected = sorted(brute.repeats([(i, text) for i, text, _, _ in TEXTS]), key=repr)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert rows_of(suffixes.repeat_report(docs, **sizes), *names) == expected
    assert suffixes.repeat_report(no_docs, **sizes).count() == 0


def test_passages_are_cut_out(docs):
    kept = suffixes.without_repeats(docs)
    assert kept.columns == docs.columns
    texts = {row.doc_id: row for row in kept.collect()}
    assert 9 not in texts
    assert texts[3].text == LONG
    assert texts[5].text.endswith("and a little more")
    assert texts[5].n_chars == len(texts[5].text)
    assert texts[11].text is None


def test_random_passages(spark):
    random.seed(11)
    letters = "abé\n"
    parts = ["".join(random.choice(letters) for _ in range(random.randint(30, 90))) for _ in range(12)]
    rows = [(random.randrange(40), "".join(random.choices(parts, k=random.randint(0, 6)))) for _ in range(60)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    found = rows_of(suffixes.repeat_report(table, chunk_size=700, bucket_size=2000, hot=5), *names)
    assert found == sorted(brute.repeats(rows), key=repr)


def test_top_k(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=40).tolist()) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 320)]
    rows += [(400, None), (450, [None] * 40), (500, [float("nan")] * 40), (550, [1.0] * 3), (None, rows[0][1])]
    rows += [(50, rows[50][1])]
    table = spark.createDataFrame(
        [(*row, "x", 1) for row in rows], "vec_id bigint, embedding array<float>, rank string, score int"
    )
    # A float column rounds its numbers, so the plain search reads them back.
    read = [(row.vec_id, row.embedding) for row in table.collect()]
    is_query = F.col("vec_id") % 50 == 0
    for block in (40, 8192):
        found = top_k.top_k(table, is_query, block=block)
        assert set(map(tuple, found.collect())) == brute.top_k(read)
    assert top_k.top_k(table.limit(0), is_query).count() == 0


PAGE = """<html><head><title>t</title><style>p{{}}</style></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">home {0}</a></ul></nav>
<div class="cookie-notice">We use cookies</div>
<article><h1>Head&nbsp;{0} &amp; more</h1><p class="lead">Read   this<br>first<p>Own <b>text {0}</p>
<p>Share this text with all your friends</p><aside>aside {0}</aside><script>var a = "</p>";</script>
<ul><li>one {0}<ul><li>two</ul>tail {0}</ul></article>
<section id="comments"><article><p>nice {0}</p></article></section><form><p>mail?</p></form>
<footer>&copy; {0}</footer></body></html>"""


def test_main_text(spark):
    rows = [(i, f"http://a.example/{i}", PAGE.format(i), "x") for i in range(6)]
    rows += [(6, "http://b.example/", PAGE.format(6), "x"), (6, "http://b.example/", PAGE.format(6), "x")]
    rows += [(7, None, None, "x"), (8, "nowhere", "", "x"), (None, None, "plain &lt;text", "x")]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    found = wrappers.main_text(table).collect()
    assert len(found) == len(rows)
    texts = {row.page_id: row.text for row in found}
    first = "\n\n".join(["Head {0} & more", "Read this first", "Own text {0}"])
    last = "\n\n".join(["one {0}", "two", "tail {0}"])
    # Over six pages of a host the constant blocks are its template; one page can't tell.
    assert texts[2] == "\n\n".join(["Head 2 & more", "Own text 2", "one 2", "tail 2"])
    assert texts[6] == "\n\n".join([first, "Share this text with all your friends", last]).format(6)
    assert (texts[7], texts[8], texts[None]) == ("", "", "plain <text")
    assert all(row.n_chars == len(row.text) for row in found)
    assert wrappers.main_text(table.limit(0)).count() == 0


def texts_of(spark, pages):
    """The main texts of pages of one host, by their places in the list."""
    rows = [(i, "http://a.example/", page) for i, page in enumerate(pages)]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return {row.page_id: row.text for row in wrappers.main_text(table).collect()}


def test_texts_of_copies_and_of_odd_pages_stay(spark):
    story = "<p>The first part of a long story about a river.</p><p>The second part of it.</p>"
    last = "<p>The end of the story, which only its copies have.</p>"
    copies = [f"<article>{story}{last}<p>day {i}</p></article>" for i in range(12)]
    others = [f"<article><p>Page {i} is about the {i}</p></article>" for i in range(8)]
    texts = texts_of(spark, copies + others)
    assert texts[3] == "\n\n".join(
        [
            "The first part of a long story about a river.",
            "The second part of it.",
            "The end of the story, which only its copies have.",
            "day 3",
        ]
    )
    notes = ["Call us", *["All rights kept"] * 19]
    pages = [f"<article><p>Page {i} is about the {i}</p><p>{x}</p></article>" for i, x in enumerate(notes)]
    texts = texts_of(spark, pages)
    assert texts[0] == "Page 0 is about the 0\n\nCall us"
    assert texts[1] == "Page 1 is about the 1"


def test_templates_that_one_page_lacks(spark):
    words = [f"Page {i} is about the {i} and what belongs to it" for i in range(40)]
    promo = "<p>Win a journey to the sea</p>"
    pages = [f"<article><p>{x}</p>{promo * (i % 2)}<p>End {i}</p></article>" for i, x in enumerate(words)]
    texts = texts_of(spark, ["", "<p>Not found</p>", *pages])
    assert all(texts[i + 2] == f"{x}\n\nEnd {i}" for i, x in enumerate(words))
    one = [f"<div class=a><p>{x}</p><p>First kind</p></div>" for x in words[:30]]
    two = [f"<table><tr><td>{x}<td>Second kind</table>" for x in words[30:]]
    texts = texts_of(spark, one + two)
    assert [texts[i] for i in range(40)] == words


def test_many_copies_are_one_page(spark):
    story = "<p>The first part of a long story about a river.</p><p>The second part of it.</p>"
    copies = [f"<article>{story}<p>day {i}</p></article>" for i in range(60)]
    others = [f"<article><p>Page {i} is about the {i}</p></article>" for i in range(5)]
    texts = texts_of(spark, copies + others)
    assert texts[0] == "The first part of a long story about a river.\n\nThe second part of it.\n\nday 0"


@pytest.mark.parametrize(
    "page",
    [
        "<div class='content has-sidebar'>{0}<div class=sidebar>{1}</div></div>",
        "<div class='no-sidebar'><article>{0}</article></div><div class=comments><article>{1}</article></div>",
        "<div id='social-layout'><main>{0}</main><section class=comments><article>{1}</article></section></div>",
        "<body><form action=x><div class='with-comments'>{0}</div><button>go</button></form>",
        "<div class='content'>{0}</div><div class='comments'>{1}{1}{1}{1}</div><form>{1}</form>",
        "<article>{0}</article><div class='related-posts'>{1}{1}{1}{1}{1}{1}</div>",
        "<p>A long text of the page<span class=share>Share</span> that goes on.</p>",
    ],
)
def test_containers_with_the_words_of_notices(page):
    tree = wrappers.Tree(page.format("<p>A long text of the page that goes on.</p>", "<p>Nice one</p>"))
    assert [text for _, text in tree.blocks] == ["A long text of the page that goes on."]


def test_tree_matching_with_deep_and_broken_pages():
    deep = wrappers.Tree("<div>" * 500 + "x" + "</p>" * 3)
    other = wrappers.Tree("<div>" * 400 + "y<p>z")
    assert len(wrappers.Alignment(deep, other).nodes()) == 401
    assert wrappers.Tree("<p>a<!-- no end").blocks == [(1, "a")]
    assert wrappers.Tree("<script>no end").blocks == []
    assert wrappers.Tree('<a title=">" href=x>b</a>').blocks == []
    one, two = wrappers.Tree("<ul><li>a<li>b</ul>"), wrappers.Tree("<ul><li>a<li>n<li>b</ul>")
    assert wrappers.Alignment(one, two).weight(0, 0) == 4


def test_headings_of_some_articles_stay(spark):
    end = "<h2>References</h2><p>Thanks to all who helped</p>"
    pages = [f"<article><p>Page {i} is about the {i}</p>{end * (i < 6)}</article>" for i in range(20)]
    texts = texts_of(spark, pages)
    for i in range(20):
        rest = "\n\nReferences\n\nThanks to all who helped" * (i < 6)
        assert texts[i] == f"Page {i} is about the {i}{rest}"


DEEP = "<div>" * 60_000


@pytest.mark.parametrize(
    "page, other, least",
    [
        (DEEP + "<p>end</p>", DEEP + "<ul><li>x</ul>", 60_000),
        ("<div><b>" * 100_000 + "x", "<div><b>" * 100_000 + "<p>y", 100_000),
        ("<a " * 350_000, "<p>x", 0),
        ("<!" * 350_000, "<p>x", 0),
        ("<b>" * 20_000 + "</i>" * 20_000, "<b>" * 20_000, 20_000),
        ("<ul>" * 10_000 + "x" + "</ul>" * 10_000, "<ul>" * 9_000, 9_000),
        ("<div class=ad>" * 20_000 + "<article><p>inner", "<div class=ad>" * 20_000 + "<article><p>i<p>j", 20_000),
        (
            "<table>" + "".join(f"<tr><td>{'<b>' * (i % 9)}x" for i in range(20_000)) + "</table>",
            "<table>" + "".join(f"<tr><td>{'<i>' * (i % 7)}x" for i in range(20_000)) + "</table>",
            20_000,
        ),
    ],
)
def test_deep_broken_and_unlike_pages_end_soon(page, other, least):
    start = time.perf_counter()
    trees = wrappers.Tree(other), wrappers.Tree(page)
    aligned = wrappers.Alignment(*trees).nodes()
    assert time.perf_counter() - start < 10
    assert len(aligned) >= least
    for node, mate in aligned.items():
        assert trees[1].tags[node] == trees[0].tags[mate]
        assert not node or aligned[trees[1].above[node]] == trees[0].above[mate]


def test_matching_is_the_best_one():
    """Against all matchings of small trees, tried one by one."""
    rng = random.Random(3)

    def markup(depth):
        if depth == 0 or rng.random() < 0.2:
            return ""
        return "".join(f"<{tag}>{markup(depth - 1)}</{tag}>" for tag in rng.choices("bius", k=rng.randint(0, 3)))

    def best(one, a, other, b):
        if one.tags[a] != other.tags[b]:
            return 0

        @functools.cache
        def of_lists(i, k):
            if i == len(one.children[a]) or k == len(other.children[b]):
                return 0
            pair = best(one, one.children[a][i], other, other.children[b][k])
            return max(of_lists(i + 1, k), of_lists(i, k + 1), pair + of_lists(i + 1, k + 1))

        return 1 + of_lists(0, 0)

    for _ in range(150):
        one, other = wrappers.Tree(markup(4)), wrappers.Tree(markup(4))
        alignment = wrappers.Alignment(one, other)
        assert len(alignment.nodes()) == best(one, 0, other, 0) == alignment.weight(0, 0)
        limited = wrappers.Alignment(one, other, work=2).nodes()
        assert len(limited) <= best(one, 0, other, 0)


def test_matching_is_the_best_one_at_any_size():
    """The bound on what is held changes no matching; lists of children may be long."""
    rng = random.Random(5)

    def rows(count):
        return "<ul>" + "".join(f"<li>{'<b></b>' * rng.randint(0, 5)}</li>" for _ in range(count)) + "</ul>"

    for long, short in [(150, 140), (140, 20), (20, 140), (12, 9)]:
        one, other = wrappers.Tree(rows(long)), wrappers.Tree(rows(short))
        lists = [[len(tree.children[node]) for node in tree.children[1]] for tree in (one, other)]
        table = [[0] * (short + 1) for _ in range(long + 1)]
        for i, x in enumerate(lists[0]):
            for k, y in enumerate(lists[1]):
                table[i + 1][k + 1] = max(table[i][k + 1], table[i + 1][k], table[i][k] + 1 + min(x, y))
        for work in (0, 2, 1000, wrappers.WORK):
            alignment = wrappers.Alignment(one, other, work=work)
            assert alignment.weight(0, 0) == 2 + table[-1][-1] == len(alignment.nodes())
        assert wrappers.Alignment(one, other, work=2).nodes() == wrappers.Alignment(one, other).nodes()
