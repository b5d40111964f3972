"""Secret scans through an inverted index of trigrams.

Each rule's pattern gives a Boolean query: an OR of sets of lower-case trigrams, one of
which every match must hold in full. The index has a posting for each document and each
trigram that some query asks for. A query's postings are intersected per document; the
documents that remain are verified with the pattern itself. A rule whose pattern has no
mandatory trigram is run on all documents.

A posting names its document by id and a hash of the text, so rows that share an id, or have
none, stay apart, and equal rows share one verdict.

Defined results: a null text is an empty one, without spans. Starts and ends count code
points. Matches of one kind don't overlap and are the leftmost ones; a match that fails its
rule's length is dropped and not tried again. Other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from re import _constants as ops
from re import _parser as patterns

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.operators.computed import with_computed

ROW = "_row"
MASK = "[SECRET]"
# Fixed patterns of the base kinds. The last two have the least length of a match in the
# pattern: their matches are whole runs, so a shorter run holds no match at all.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
    r"([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# A key reaches from its first line to its last one, or, if that is missing, over the base64
# run: up to its last 32 characters in a row, and one shorter word that is not only letters.
# There is no repeated group, so a match needs no deep stack, and no body goes past a hyphen,
# so many first lines without a last one are read once.
PRIVATE_KEY = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
    r"(?:[\x20\t\r\n\\]*n?Proc-Type:\x20*[0-9]+,[A-Z-]+[\x20\t\r\n\\]*n?DEK-Info:\x20*[A-Z0-9-]+,[0-9A-Fa-f]+)?"
    r"(?:[^-]*-----END [A-Z ]*PRIVATE KEY-----"
    r"|(?:[A-Za-z0-9+/\x20\t\r\n\\]*[A-Za-z0-9+/]{32}=*)?"
    r"(?:[\x20\t\r\n\\]+[A-Za-z]*[0-9+/=][A-Za-z0-9+/=]*)?)"
)


@dataclass(frozen=True)
class Rule:
    """A kind of secret; ``group`` of a match must have ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


RULES = (
    Rule("assign", ASSIGN, group=2, least=6, base=True),
    Rule("access", ACCESS, base=True),
    Rule("hex", HEX, base=True),
    Rule("private_key", PRIVATE_KEY),
    Rule("slack", r"xox[baprs]-[0-9A-Za-z-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
)

Alternatives = list[frozenset[str]]


def _trigrams(literal: str) -> frozenset[str]:
    low = literal.lower()
    return frozenset(low[i : i + 3] for i in range(len(low) - 2))


def _both(left: Alternatives, right: Alternatives) -> Alternatives:
    return [a | b for a in left for b in right]


def _needed(items) -> Alternatives:
    """What a sequence of pattern items needs; [{}] if nothing is mandatory."""
    found: Alternatives = [frozenset()]
    literal = ""
    for op, value in items:
        if op is ops.LITERAL and value < 128:
            literal += chr(value)
            continue
        found, literal = _both(found, [_trigrams(literal)]), ""
        if op is ops.SUBPATTERN:
            found = _both(found, _needed(value[3]))
        elif op is ops.BRANCH:
            found = _both(found, [x for branch in value[1] for x in _needed(branch)])
        elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT) and value[0] > 0:
            found = _both(found, _needed(value[2]))
    return _both(found, [_trigrams(literal)])


def trigram_query(pattern: str) -> Alternatives:
    """The Boolean query of a pattern: sets of trigrams, any one of which must be complete.

    An empty list says that the pattern has a match without mandatory trigrams.
    """
    needed = _needed(patterns.parse(pattern))
    return [] if frozenset() in needed else sorted(set(needed), key=sorted)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("text_hash", F.xxhash64("text"))


def trigram_index(docs: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """A posting (trigram, doc_id, text_hash) for each document that has the trigram."""
    wanted = F.array(*[F.lit(x) for x in trigrams]) if trigrams else F.array().cast("array<string>")
    held = with_computed(_keyed(docs), _low=F.lower("text")).select(
        "doc_id",
        "text_hash",
        F.filter(wanted, lambda trigram: F.contains(F.col("_low"), trigram)).alias("_held"),
    )
    return held.select(F.explode("_held").alias("trigram"), "doc_id", "text_hash")


def candidates(index: DataFrame, queries: dict[str, Alternatives]) -> DataFrame:
    """The documents whose postings satisfy a query, with the kinds that they may hold."""
    held = index.groupBy("doc_id", "text_hash").agg(F.collect_set("trigram").alias("_held"))

    def satisfied(query: Alternatives) -> Column:
        sets = [F.array(*[F.lit(x) for x in sorted(needed)]) for needed in query]
        return reduce(
            lambda a, b: a | b, [F.size(F.array_except(needed, "_held")) == 0 for needed in sets]
        )

    kinds = F.array_compact(
        F.array(
            F.lit(None).cast("string"),
            *[F.when(satisfied(query), kind) for kind, query in queries.items()],
        )
    )
    return held.select("doc_id", "text_hash", kinds.alias("kinds")).filter(F.size("kinds") > 0)


def _spans(rule: Rule, place: int) -> Column:
    """The matches of a rule as (start, place, kind, end), from the columns _m, _g and _s.

    The text between two matches and the matches themselves add up to the starts.
    """
    matches, groups, between = (F.col(f"{name}_{rule.kind}") for name in ("_m", "_g", "_s"))

    def add(state: Column, k: Column) -> Column:
        start = state["at"] + F.length(F.get(between, k))
        end = start + F.length(F.get(matches, k))
        span = F.struct(
            start.cast("bigint").alias("start"),
            F.lit(place).alias("place"),
            F.lit(rule.kind).alias("kind"),
            end.cast("bigint").alias("end"),
        )
        long_enough = F.length(F.get(groups, k)) >= rule.least
        return F.struct(
            end.cast("bigint").alias("at"),
            F.when(long_enough, F.concat(state["found"], F.array(span)))
            .otherwise(state["found"])
            .alias("found"),
        )

    none = F.array().cast("array<struct<start:bigint,place:int,kind:string,end:bigint>>")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("found"))
    places = F.sequence(F.lit(0), F.size(matches) - 1)
    found = F.aggregate(places, start, add, lambda state: state["found"])
    return F.when(F.size(matches) > 0, found).otherwise(none)


def scanned(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` as the struct ``_row``, with all spans as the array ``spans``."""
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    indexed = {kind: query for kind, query in queries.items() if query}
    trigrams = sorted({x for query in indexed.values() for needed in query for x in needed})
    found = candidates(trigram_index(docs, trigrams), indexed).select(
        F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_text_hash"), "kinds"
    )
    rows = docs.select(
        F.struct(*[docs[name] for name in docs.columns]).alias(ROW),
        F.coalesce(docs["text"], F.lit("")).alias("_text"),
    )
    same = F.col(f"{ROW}.doc_id").eqNullSafe(F.col("_doc_id")) & (
        F.xxhash64("_text") == F.col("_text_hash")
    )
    joined = rows.join(found, same, "left").select(ROW, "_text", "kinds")

    none = F.array().cast("array<string>")
    columns = {}
    for rule in rules:
        pattern = F.lit(rule.pattern)
        tried = F.array_contains("kinds", rule.kind) if rule.kind in indexed else F.lit(True)
        whole = F.when(tried, F.regexp_extract_all("_text", pattern, F.lit(0))).otherwise(none)
        columns[f"_m_{rule.kind}"] = F.coalesce(whole, none)
    matched = with_computed(joined, **columns)
    details = {}
    for rule in rules:
        some = F.size(f"_m_{rule.kind}") > 0
        group = F.regexp_extract_all("_text", F.lit(rule.pattern), F.lit(rule.group))
        if rule.group == 0:
            group = F.col(f"_m_{rule.kind}")
        details[f"_g_{rule.kind}"] = F.when(some, group)
        details[f"_s_{rule.kind}"] = F.when(some, F.split("_text", rule.pattern, -1))
    detailed = with_computed(matched, **details)
    spans = F.array_sort(F.concat(*[_spans(rule, place) for place, rule in enumerate(rules)]))
    return with_computed(detailed, spans=spans).select(ROW, "_text", "spans")


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )


def secret_report(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Counts and digests of the spans of each document."""
    base = [rule.kind for rule in rules if rule.base]

    def of_kind(kind: str) -> Column:
        return F.filter("spans", lambda x: x["kind"] == kind)

    counts = [F.size(of_kind(kind)).cast("bigint").alias(f"n_{kind}") for kind in base]
    of_base = F.filter("spans", lambda x: x["kind"].isin(base))
    return scanned(docs, rules).select(
        F.col(f"{ROW}.doc_id").alias("doc_id"),
        *counts,
        F.sha2(_joined(of_base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def mask_secrets(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The documents with each run of secret characters replaced by a mark.

    Spans that overlap or touch are replaced together. A null text stays null. The columns
    are those of ``docs``; ``n_chars``, if there is one, follows the text.
    """

    def add(state: Column, span: Column) -> Column:
        kept = F.substring("_text", (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        apart = (span["start"] > state["at"]) | (state["text"] == "")
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(apart, F.concat(state["text"], kept, F.lit(MASK))).otherwise(state["text"]).alias("text"),
        )

    first = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("text"))
    rest = lambda state: F.concat(
        state["text"], F.substring("_text", (state["at"] + 1).cast("int"), F.length("_text"))
    )
    masked = F.when(F.size("spans") > 0, F.aggregate("spans", first, add, rest)).otherwise(
        F.col(f"{ROW}.text")
    )
    out = with_computed(scanned(docs, rules), _masked=masked)
    columns = []
    for name in docs.columns:
        if name == "text":
            columns.append(F.col("_masked").alias("text"))
        elif name == "n_chars":
            kind = docs.schema[name].dataType
            size = F.length("_masked").cast(kind)
            columns.append(F.when(F.size("spans") > 0, size).otherwise(F.col(ROW)[name]).alias(name))
        else:
            columns.append(F.col(ROW)[name].alias(name))
    return out.select(*columns)
