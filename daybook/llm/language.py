"""Language by multinomial naive Bayes over hashed character n-grams.

Learning adds up, per language, how often each of ``BUCKETS`` hashed n-grams occurs. Each
task adds up its own texts first, so what is shuffled and what reaches the driver is bounded
by languages times buckets, whatever the size of the corpus. The matrix of log-probabilities
is broadcast; its size has the same bound. Texts are sparse rows of n-gram counts. The rows of
a batch, in the form of places, buckets and counts, are multiplied with the matrix at once.

At most ``MOST_LANGUAGES`` languages are learned, those with the most documents, so that a
column with other things in it can't grow the matrix beyond bounds.

Defined results: a null text, and one without a letter, is ``und`` with score 0, as is every
text if nothing was learned. Equal scores go to the first language by name. Rows without an
id are neither held out nor learned from; a null language is not learned from. Repeated rows
count each time. Columns other than doc_id, text and lang don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 14
LENGTHS = (1, 2, 3)
SMOOTHING = 0.5
SLICE = 1 << 18
MOST_LANGUAGES = 256
#: Entries of sparse rows that are multiplied at once.
ENTRIES = 1 << 18
UNKNOWN = "und"
DOCUMENTS = -1


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def slices(text: str) -> Iterator[np.ndarray]:
    """The buckets of a text's n-grams, in slices that overlap by what an n-gram needs."""
    more = max(LENGTHS) - 1
    for start in range(0, len(text), SLICE):
        part = text[start : start + SLICE + more].lower()
        codes = np.frombuffer(part.encode("utf-32-le"), np.uint32)
        for length in LENGTHS:
            first = codes[: len(codes) - length + 1][:SLICE].astype(np.uint32)
            for step in range(1, length):
                first = first * np.uint32(0x01000193) + codes[step : step + len(first)]
            first = (first + np.uint32(length)) * np.uint32(0x9E3779B1)
            yield first >> np.uint32(32 - BUCKETS.bit_length() + 1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    documents: dict[str, int] = {}
    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1)):
            name = lang.as_py()
            documents[name] = documents.get(name, 0) + 1
            total = counts.setdefault(name, np.zeros(BUCKETS, np.int64))
            for buckets in slices(text.as_py()):
                total += np.bincount(buckets, minlength=BUCKETS)
    for name, total in counts.items():
        seen = np.append(DOCUMENTS, np.flatnonzero(total)).astype(np.int32)
        number = np.append(documents[name], total[total > 0])
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(seen)), pa.array(seen), pa.array(number.astype(np.int64))],
            ["lang", "bucket", "n"],
        )


class Model:
    """Languages by name, and the log-probabilities of buckets (rows) and of languages.

    ``places``, ``buckets`` and ``numbers`` tell how often each language has each bucket; the
    bucket ``DOCUMENTS`` has its documents.
    """

    def __init__(self, names: list[str], places, buckets, numbers) -> None:
        self.names = names
        counts = np.zeros((BUCKETS + 1, len(names)))
        counts[buckets, places] = numbers
        grams, documents = counts[:-1], counts[-1]
        total = grams.sum(axis=0) + SMOOTHING * BUCKETS
        self.grams = np.log((grams + SMOOTHING) / total).astype(np.float32)
        self.prior = np.log(documents / max(1.0, documents.sum()))

    @classmethod
    def restored(cls, state: dict) -> Model:
        """The model whose attributes were broadcast."""
        model = cls.__new__(cls)
        vars(model).update(state)
        return model

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The scores of some texts, given as sparse rows: buckets that occur, and how often."""
        starts = np.cumsum([0, *(len(buckets) for buckets, _ in rows[:-1])])
        buckets, counts = (np.concatenate(part) for part in zip(*rows))
        product = self.grams[buckets] * counts[:, None].astype(np.float64)
        return self.prior + np.add.reduceat(product, starts, axis=0)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and score of each text."""
        found = [(UNKNOWN, 0.0)] * len(texts)
        rows: list[tuple[np.ndarray, np.ndarray]] = []
        places: list[int] = []

        def score() -> None:
            scores = self.scores(rows)
            best = scores.argmax(axis=1)
            share = 1 / np.exp(scores - scores.max(axis=1, keepdims=True)).sum(axis=1)
            for place, language, value in zip(places, best.tolist(), share.tolist()):
                found[place] = self.names[language], value
            rows.clear()
            places.clear()

        entries = 0
        for place, text in enumerate(texts):
            if self.names and text and any(map(str.isalpha, text)):
                counts = np.zeros(BUCKETS, np.int64)
                for buckets in slices(text):
                    counts += np.bincount(buckets, minlength=BUCKETS)
                held = np.flatnonzero(counts)
                rows.append((held, counts[held]))
                places.append(place)
                entries += len(held)
                if entries >= ENTRIES:
                    score()
                    entries = 0
        if rows:
            score()
        return found


def learned(docs: DataFrame, most_languages: int = MOST_LANGUAGES) -> Model:
    """The model of the texts and languages of documents that are not held out."""
    of_known = docs.filter(
        F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
    ).filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    by_size = of_known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang")
    names = sorted(row.lang for row in by_size.limit(most_languages).collect())
    if not names:
        return Model([], [], [], [])
    known = F.array(*[F.lit(name) for name in names])
    wanted = of_known.filter(F.col("lang").isin(names))
    counts = (
        wanted.select("text", "lang")
        .mapInArrow(_count, "lang string, bucket int, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .select((F.array_position(known, F.col("lang")) - 1).alias("place"), "bucket", "n")
        .toArrow()
    )
    return Model(names, *(counts.column(name).to_numpy() for name in ("place", "bucket", "n")))


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row, from its text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model.restored(shared.value)
        for batch in batches:
            found = own.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([name for name, _ in found], pa.string()),
                    pa.array([score for _, score in found], pa.float64()),
                ],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"
    ).mapInArrow(of_batches, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
