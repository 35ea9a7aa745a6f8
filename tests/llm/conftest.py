import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from courtside.llm.tables import ship  # noqa: E402


@pytest.fixture(scope="session")
def llm(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def documents(llm):
    """Makes (doc_id, text, lang, source) rows a table with further columns whose names clash with internal ones."""

    def make(rows):
        full = [(*r, *[None] * (4 - len(r))) for r in rows]
        df = llm.createDataFrame(full, "doc_id long, text string, lang string, source string")
        return df.selectExpr(
            "doc_id", "text", "lang", "source", "1 AS n", "'x' AS h", "2 AS slot", "'k' AS key", "3L AS component", "4 AS doc"
        )

    return make
