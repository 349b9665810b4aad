from __future__ import annotations

import pandas as pd
import pytest

from wattspindle.llm.common import ship_code

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def llm(spark):
    ship_code(spark)
    return spark


@pytest.fixture(scope="session")
def documents(llm, sf_dir) -> pd.DataFrame:
    return llm.read.parquet(f"{sf_dir}/documents.parquet").toPandas()


@pytest.fixture
def make(llm):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) rows."""

    def build(*rows):
        full = [(*r, *[None] * (5 - len(r))) for r in rows]
        return llm.createDataFrame(full, DOCUMENTS)

    return build


@pytest.fixture(scope="session")
def odd_texts() -> list:
    """Nulls, empty, blank, very long, other scripts, ties and odd white space."""
    long = " ".join(f"w{i % 700}x{i}" for i in range(30_000))
    return [
        None, "", "   \n\t", "one", "one two", "ONE Two", "one two three", "a " * 300, long, long,
        "été über 東京 Ünïcode",
        "x\x0by\x0cz w\x1cq   r", "\x00\x00 \x00", "日本語のテキスト", "1234 5678 !!!", "a" * 5000,
    ]
