"""Personal data, and terms that give it away, by information content.

Protected entities are the personal data that fixed patterns find. How strongly a term
reveals an entity is estimated from the whole texts of the corpus: with p the share of
documents that hold something, a term t discloses PMI(t; e) = log2(p(t, e) / (p(t) p(e))) bits
of the -log2 p(e) bits that the entity e holds. A term that discloses at least ``GENERALISE``
of them is generalised to its kind, one that discloses at least ``REMOVE`` of them is removed,
wherever it stands, also in documents without the entity (after Sanchez and Batet,
"C-sanitized", 2016).

A few documents tell nothing about co-occurrence: at least ``EVIDENCE`` of them must hold the
pair, and these must be unlike each other, as copies of a text share all of their words. Texts
that share a band of minimum hashes of five-word shingles, directly or in steps, are one piece
of evidence; all of their documents count in p.

Not all pairs are formed. Entities without enough texts can't have evidence. For the others a
term that more documents hold than the bound that follows from the least share can't disclose
them, however often they meet. The texts of entities alone show that of most terms, so few
pairs are formed. An entity or term that a third of all documents hold is summed up before
it is shuffled, and joined as single rows, which adaptive execution can split.

Defined results: a null text is an empty one, without spans. Starts and ends count code
points. Base spans of one kind don't overlap and are the leftmost ones; a match that fails
its check is dropped and not tried again. Words in base spans are no terms of a text, but
count as occurrences of a term elsewhere. Rows with a null or repeated id have a result
each. A text of any length is read as a whole. Columns other than doc_id and text don't matter.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.bands import bands
from daybook.llm.links import components
from daybook.llm.saving import saved

KINDS = ("email", "ip", "card", "phone")
EVIDENCE = 3
GENERALISE = 0.85
REMOVE = 0.95
COUNTED_AT_ONCE = 200_000
#: Sets of any size travel to the tasks as filters of 2 ** FILTER_BITS bits.
FILTER_BITS = 22
WORDS_REMEMBERED = 500_000

# Fixed patterns of the base kinds. The e-mail pattern is split at its sign, and the others
# say where a match can begin at all: this gives the same matches in linear time.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\W\d_]+")
LOCAL_CHARACTERS = frozenset(
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
)


def luhn(digits: str) -> bool:
    """Whether the last digit checks the others."""
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(x), 10)) for x in even)) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each sign back over the name, but not into the match before, and on over the host."""
    end, sign = 0, text.find("@")
    while sign >= 0:
        start = sign
        while start > end and text[start - 1] in LOCAL_CHARACTERS:
            start -= 1
        host = DOMAIN.match(text, sign) if start < sign else None
        if host:
            end = host.end()
            yield start, end
        sign = text.find("@", sign + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) of all base spans, in this order."""
    found = [(start, 0, end) for start, end in emails(text)]
    for match in IP.finditer(text):
        parts = [part.lstrip("0") or "0" for part in match[0].split(".")]
        if all(len(part) <= 3 and int(part) <= 255 for part in parts):
            found.append((match.start(), 1, match.end()))
    for match in CARD.finditer(text):
        digits = match[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((match.start(), 2, match.end()))
    for match in PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, match[0])) <= 15:
            found.append((match.start(), 3, match.end()))
    return sorted(found)


def words_outside(text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """The places of the words that no span touches."""
    starts = [start for start, _, _ in spans]
    longest = max((end - start for start, _, end in spans), default=0)
    for match in WORD.finditer(text):
        start, end = match.span()
        at = bisect_left(starts, start - longest)
        while at < len(spans) and starts[at] < end and spans[at][2] <= start:
            at += 1
        if at == len(spans) or starts[at] >= end:
            yield start, end


def terms_of(text: str) -> set[str]:
    return {word.lower() for word in set(WORD.findall(text))}


SPAN = "struct<start:bigint,place:int,end:bigint>"
SPAN_TYPE = pa.struct([("start", pa.int64()), ("place", pa.int32()), ("end", pa.int64())])


def text_hash():
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")


class Filter:
    """A set of hashes as bits: lets all of the set through, with others."""

    def __init__(self, hashes: DataFrame):
        places = hashes.select(F.pmod(hashes.columns[0], F.lit(1 << FILTER_BITS)).cast("int")).distinct()
        bits = np.zeros(1 << FILTER_BITS, bool)
        bits[[row[0] for row in places.collect()]] = True
        packed = np.packbits(bits, bitorder="little")
        self.shared = hashes.sparkSession.sparkContext.broadcast(packed)
        self.known: dict[str, bool] = {}

    def __getstate__(self):
        return {"shared": self.shared, "known": {}}

    def has(self, value: int) -> bool:
        place = value % (1 << FILTER_BITS)
        return bool(self.shared.value[place >> 3] >> (place & 7) & 1)

    def has_term(self, term: str) -> bool:
        """The same for the hash of a term, remembered for some time."""
        found = self.known.get(term)
        if found is None:
            if len(self.known) >= WORDS_REMEMBERED:
                self.known.clear()
            found = self.known[term] = self.has(xxhash.xxh64_intdigest(term, 42))
        return found


def found_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, spans, entities) for each row of ``docs``."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, entities = [], []
            for value in batch.column(2):
                text = value.as_py() or ""
                own = base_spans(text)
                spans.append([dict(zip(("start", "place", "end"), x)) for x in own])
                entities.append(sorted({f"{KINDS[kind]}:{text[start:end].lower()}" for start, kind, end in own}))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(spans, pa.list_(SPAN_TYPE)),
                    pa.array(entities, pa.list_(pa.string())),
                ],
                ["doc_id", "text_hash", "spans", "entities"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", text_hash(), "text").mapInArrow(
        of_batches, f"doc_id {kind}, text_hash bigint, spans array<{SPAN}>, entities array<string>"
    )
    return saved(found, "spans")


def entity_places(found: DataFrame, evidence: int) -> DataFrame:
    """(text_hash, entity, n, with_entity): texts of entities that enough texts have.

    ``n`` counts the documents of the text, ``with_entity`` those of the entity.
    """
    of_texts = (
        found.filter(F.size("entities") > 0)
        .select("text_hash", F.explode("entities").alias("entity"))
        .groupBy("text_hash", "entity")
        .agg(F.count("*").alias("n"))
    )
    of_texts = saved(of_texts, "entity-texts")
    several = (
        of_texts.groupBy("entity")
        .agg(F.sum("n").alias("with_entity"), F.count("*").alias("texts"))
        .filter(F.col("texts") >= evidence)
        .drop("texts")
    )
    return saved(of_texts.join(saved(several, "entities"), "entity"), "entity-places")


def text_terms(docs: DataFrame, hashes: DataFrame) -> DataFrame:
    """(text_hash, terms, bands) of the texts with one of the hashes, and of some others."""
    wanted = Filter(hashes)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                if wanted.has(key):
                    text = value.as_py() or ""
                    words = {text[a:b].lower() for a, b in words_outside(text, base_spans(text))}
                    rows.append((key, sorted(words), bands(text)))
            kinds = (pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)],
                ["text_hash", "terms", "bands"],
            )

    found = docs.select(text_hash(), "text").mapInArrow(
        of_batches, "text_hash bigint, terms array<string>, bands array<bigint>"
    )
    one = found.groupBy("text_hash").agg(F.first("terms").alias("terms"), F.first("bands").alias("bands"))
    return saved(one, "terms")


def term_counts(docs: DataFrame) -> DataFrame:
    """(term, with_term): in how many documents of the corpus each term occurs.

    Each task adds up its own texts before it hands the counts on.
    """

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            terms, numbers = list(counts.keys()), list(counts.values())
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(terms, pa.string()), pa.array(numbers, pa.int64())], ["term", "n"]
            )

        for batch in batches:
            for text in batch.column(0):
                counts.update(terms_of(text.as_py()))
                if len(counts) > COUNTED_AT_ONCE:
                    yield out()
        yield out()

    texts = docs.filter(F.col("text").isNotNull()).select("text")
    counted = texts.mapInArrow(of_batches, "term string, n bigint")
    return saved(counted.groupBy("term").agg(F.sum("n").alias("with_term")), "term-counts")


def unlike_texts(terms: DataFrame) -> DataFrame:
    """(text_hash, alike): texts that share a band, directly or in steps, have one number."""
    banded = terms.select("text_hash", F.explode("bands").alias("band"))
    least = saved(
        banded.groupBy("band")
        .agg(F.min("text_hash").alias("b"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("band", "b"),
        "bands",
    )
    links = banded.join(least, "band").select(F.col("text_hash").alias("a"), "b")
    groups = components(links).select(F.col("node").alias("text_hash"), "root")
    return terms.select("text_hash").join(groups, "text_hash", "left").select(
        "text_hash", F.coalesce("root", "text_hash").alias("alike")
    )


def disclosing_pairs(
    docs: DataFrame,
    found: DataFrame,
    evidence: int = EVIDENCE,
    least: float = GENERALISE,
) -> DataFrame:
    """(entity, term, share): pairs in which the term discloses at least a share of the entity."""
    places = entity_places(found, evidence)
    of_texts = saved(places.groupBy("text_hash").agg(F.max("n").alias("n")), "texts-of-entities")
    terms = text_terms(docs, of_texts.select("text_hash"))
    terms = saved(terms.join(of_texts, "text_hash"), "terms-of-texts")
    total = found.count()

    # together <= with_entity, so this is the most documents that a disclosing term can have.
    bits = F.log2(total / F.col("with_entity"))
    bound = F.col("with_entity") * F.pow(F.lit(2.0), (1 - least) * bits) * (1 + 1e-9)
    most = places.agg(F.max(bound)).first()[0] or 0.0
    exploded = terms.select("text_hash", "n", F.explode("terms").alias("term"))
    # The texts of entities alone show that most words are too frequent.
    rare = exploded.groupBy("term").agg(F.sum("n").alias("at_least")).filter(F.col("at_least") <= most)
    rare = saved(rare, "rare-terms")
    placed = places.select("*", bound.alias("bound")).join(unlike_texts(terms), "text_hash")
    pairs = exploded.drop("n").join(rare, "term").join(placed, "text_hash").filter("at_least <= bound")
    together = saved(
        pairs.groupBy("entity", "term", "with_entity", "alike")
        .agg(F.sum("n").alias("n"))
        .groupBy("entity", "term", "with_entity")
        .agg(F.sum("n").alias("together"), F.count("*").alias("unlike"))
        .filter(F.col("unlike") >= evidence),
        "together",
    )
    together = together.join(term_counts(docs), "term")
    pmi = F.log2(F.col("together") * total / (F.col("with_term") * F.col("with_entity")))
    share = F.when(bits > 0, pmi / bits).otherwise(0.0)
    return together.select("entity", "term", share.alias("share")).filter(F.col("share") >= least)


def term_places(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, text_hash, start, end, place) of the given terms (term, place), in all texts."""
    wanted = Filter(terms.select(F.xxhash64("term").alias("hash")))
    kind = docs.schema["doc_id"].dataType.simpleString()
    hit = pa.list_(pa.struct([("term", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for row, value in enumerate(batch.column(2)):
                text = value.as_py() or ""
                candidates = {term for term in terms_of(text) if wanted.has_term(term)}
                if candidates:
                    outside = words_outside(text, base_spans(text))
                    named = ((text[a:b].lower(), a, b) for a, b in outside)
                    rows.append(row)
                    found.append(
                        [{"term": term, "start": a, "end": b} for term, a, b in named if term in candidates]
                    )
            chosen = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [chosen.column(0), chosen.column(1), pa.array(found, hit)], ["doc_id", "text_hash", "hits"]
            )

    hits = docs.select("doc_id", text_hash(), "text").mapInArrow(
        of_batches,
        f"doc_id {kind}, text_hash bigint, hits array<struct<term:string,start:bigint,end:bigint>>",
    )
    return hits.select("doc_id", "text_hash", F.inline("hits")).join(terms, "term").drop("term")


def disclosed(
    docs: DataFrame,
    evidence: int = EVIDENCE,
    generalise: float = GENERALISE,
    remove: float = REMOVE,
) -> DataFrame:
    """(doc_id, spans) with all spans (start, place, kind, end) of each row of ``docs``.

    Kinds are those of the base, ``term`` for what is generalised and ``removed``.
    """
    found = found_spans(docs)
    place = F.when(F.col("share") >= remove, len(KINDS) + 1).otherwise(len(KINDS))
    # Of a term that discloses several entities the strongest measure counts.
    marked = (
        disclosing_pairs(docs, found, evidence, generalise)
        .groupBy("term")
        .agg(F.max("share").alias("share"))
        .select("term", place.cast("int").alias("place"))
    )
    # Rows with equal id and text have equal places, so they are kept once.
    terms = (
        term_places(docs, saved(marked, "marked"))
        .groupBy("doc_id", "text_hash", "start", "end")
        .agg(F.max("place").alias("place"))
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_list(F.struct("start", "place", "end")).alias("terms"))
        .withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    )
    names = F.array(*[F.lit(kind) for kind in (*KINDS, "term", "removed")])
    none = F.array().cast(f"array<{SPAN}>")
    every = F.array_sort(F.concat("spans", F.coalesce("terms", none)))
    named = F.transform(
        every,
        lambda x: F.struct(x["start"], x["place"], F.get(names, x["place"]).alias("kind"), x["end"]),
    )
    same = found["doc_id"].eqNullSafe(terms["_id"]) & (found["text_hash"] == terms["_hash"])
    return found.join(terms, same, "left").select("doc_id", named.alias("spans"))


def personal_data_report(docs: DataFrame) -> DataFrame:
    """Counts and digests of the spans of each document."""

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
        )

    def of_kind(place: int):
        return F.filter("spans", lambda x: x["place"] == place)

    base = F.filter("spans", lambda x: x["place"] < len(KINDS))
    return disclosed(docs).select(
        "doc_id",
        *[F.size(of_kind(i)).cast("bigint").alias(f"n_{kind}") for i, kind in enumerate(KINDS)],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def sanitise(text: str, spans: list[tuple[int, str, int]]) -> str:
    """A text whose spans (start, kind, end) are replaced by their kind, or removed."""
    out, at = [], 0
    for start, kind, end in sorted(spans):
        if start >= at:
            out += [text[at:start], "" if kind == "removed" else f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def sanitised(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with personal data generalised and disclosing terms generalised or removed.

    A null text stays null.
    """
    spans = disclosed(docs.select(F.struct("doc_id", F.xxhash64("text").alias("h")).alias("doc_id"), "text"))
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    one = spans.select("doc_id.doc_id", "doc_id.h", "spans").dropDuplicates(["doc_id", "h"])
    one = one.select(F.col("doc_id").alias("_id"), F.col("h").alias("_h"), "spans")
    joined = keyed.join(one, keyed["doc_id"].eqNullSafe(one["_id"]) & (keyed["h"] == one["_h"]))

    @F.udf("string", useArrow=True)
    def replaced(text, spans):
        return None if text is None else sanitise(text, [(x["start"], x["kind"], x["end"]) for x in spans])

    return joined.select("doc_id", replaced("text", "spans").alias("text"))
