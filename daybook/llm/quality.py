"""Quality rules: a table of thresholds compiled into one projection.

Words are runs without white space (tab to carriage return, and blank). All measures of a
text are built-in expressions of its row; nothing is shuffled.

Defined results: a null text is an empty one; it has no words and fails the base rules. Rows
with a null or repeated id are judged like any other. Only the text is looked at, so other
columns, whatever their names, pass through untouched.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.operators.computed import with_computed

SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
ROW = "_row"

# Frequent words of languages in Latin letters.
STOP_WORDS = (
    "the of and to in is that it for on was be with as by this are or an from "
    "de la le les et des en un une que pour dans par sur est au du "
    "der die und das den von zu mit nicht ein eine für auf ist im dem "
    "el los las y del se por con una para no su al lo "
    "di che il della per non sono gli alla nel anche più come "
    "que não uma os com mais foi dos nas pelo ao "
    "het een van niet zijn voor met dat aan ook wordt bij "
    "och att som det på är inte till har med om ett den "
    "og er ikke jeg til af at "
    "ja on ei se että oli mutta kun niin "
    "nie się jest na że do jak ale przez od "
    "je v na že se s pro jako by jsou "
    "és hogy nem egy az ez volt csak meg "
    "și în cu nu este care mai din pentru "
    "ve bir bu için ile da çok daha olarak "
    "yang dan di untuk dengan ini itu dari tidak pada "
    "và của là có cho không được trong một các"
).split()
#: A text with at least so many bytes a character is mostly in other letters, and none of the
#: listed words can be expected.
OTHER_LETTERS = 1.5


@dataclass(frozen=True)
class Rule:
    """A measure, and the range in which a text may have it."""

    name: str
    measure: Column
    least: float | None = None
    most: float | None = None

    def holds(self) -> Column:
        bounds = []
        if self.least is not None:
            bounds.append(self.measure >= F.lit(self.least))
        if self.most is not None:
            bounds.append(self.measure <= F.lit(self.most))
        return F.coalesce(reduce(lambda a, b: a & b, bounds), F.lit(False))


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def threshold_table() -> list[Rule]:
    """The rules beyond the base ones, over the measures of `measured`."""
    latin = F.col("n_bytes") < OTHER_LETTERS * F.col("n_chars")
    return [
        Rule("mean_word_length", _share("word_chars", "n_words"), 2.0, 15.0),
        Rule("symbol_ratio", _share("n_symbols", "n_words"), None, 0.2),
        Rule("letter_ratio", _share("n_letters", "word_chars"), 0.5, None),
        Rule("stop_word_ratio", F.when(latin, _share("n_stop_words", "n_words")).otherwise(1.0), 0.02, None),
        Rule("duplicate_line_ratio", _share("n_dup_lines", "n_lines"), None, 0.3),
    ]


def _covered_by_repeats(hashes: Column) -> Column:
    """How many words lie in windows that occur twice or more, from the windows' hashes."""

    def covered(places: Column) -> Column:
        reach = F.transform(
            places,
            lambda place, k: F.least(
                F.lit(WINDOW), F.coalesce(F.get(places, k + 1) - place, F.lit(WINDOW))
            ),
        )
        return F.aggregate(reach, F.lit(0), lambda total, x: total + x)

    def repeated(ordered: Column) -> Column:
        same = F.filter(
            ordered,
            lambda x, k: F.coalesce(x["h"] == F.get(ordered, k - 1)["h"], F.lit(False))
            | F.coalesce(x["h"] == F.get(ordered, k + 1)["h"], F.lit(False)),
        )
        return F.array_sort(F.transform(same, lambda x: x["place"]))

    ordered = F.array_sort(
        F.transform(hashes, lambda h, k: F.struct(h.alias("h"), k.cast("int").alias("place")))
    )
    # Each transform over a one-element array names a value, so that it is computed once.
    places = F.transform(F.array(ordered), repeated)
    some = F.transform(places, covered)[0]
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), some).otherwise(F.lit(0))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` as the struct ``_row``, with the measures of their texts."""
    rows = docs.select(
        F.struct(*[docs[name] for name in docs.columns]).alias(ROW),
        F.coalesce(docs[text], F.lit("")).alias("_text"),
    )
    split = with_computed(
        rows,
        _words=F.filter(F.split("_text", SPACES), lambda word: word != ""),
        _lines=F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
    )
    word = [lambda k, step=step: F.get(F.col("_words"), k + step) for step in range(WINDOW)]
    windows = F.when(
        F.size("_words") >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.greatest(F.size("_words") - WINDOW, F.lit(0))),
            lambda k: F.xxhash64(*[at(k) for at in word]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    hashed = with_computed(split, _windows=windows)
    counts = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": F.regexp_count("_text", F.lit(SYMBOLS)),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": _covered_by_repeats(F.col("_windows")),
        "n_lines": F.size("_lines"),
        "n_bytes": F.octet_length("_text"),
        "n_chars": F.length("_text"),
        "n_letters": F.length(F.regexp_replace("_text", r"\P{L}+", "")),
        "n_stop_words": F.size(
            F.filter("_words", lambda word: F.lower(word).isin(STOP_WORDS))
        ),
    }
    counted = with_computed(
        hashed, **{name: column.cast("bigint") for name, column in counts.items()}
    )
    return counted.drop("_text", "_words", "_lines", "_windows")


def judged(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text") -> DataFrame:
    """`measured` with ``base_failed``, ``kept`` and the names of the rules that failed."""
    rules = threshold_table() if rules is None else rules
    base_failed = (F.col("n_words") < 20) | (
        100 * F.col("n_repeat_words") > 30 * F.col("n_words")
    )
    failed = F.array_compact(
        F.array(F.lit(None).cast("string"), *[F.when(~rule.holds(), rule.name) for rule in rules])
    )
    return measured(docs, text).select(
        "*",
        base_failed.alias("base_failed"),
        (~base_failed & (F.size(failed) == 0)).alias("kept"),
        failed.alias("failed_rules"),
    )


def quality_report(docs: DataFrame) -> DataFrame:
    """The measures and the verdict of each document."""
    return judged(docs).select(
        F.col(f"{ROW}.doc_id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        F.array_join("failed_rules", ",").alias("failed_rules"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass all rules, with their columns as they were."""
    return judged(docs).filter("kept").select(f"{ROW}.*")
