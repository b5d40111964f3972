import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from odd_texts import SCHEMA, TEXTS  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and long texts, repeated rows, and columns with clashing names."""
    rows = [(i, text, lang, source, None if text is None else len(text), "x", "y", 1, None) for i, text, lang, source in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
