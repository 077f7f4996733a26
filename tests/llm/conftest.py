import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts or (id, text) pairs."""
    def make(*texts, extra: str = ""):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame(
            [(i, t, "en", "s", len(t or "")) for i, t in rows], T._parse_datatype_string(DOCS))
    return make


PROSE = ("the quick brown fox jumps over a lazy dog while seven wizards box with jolly elves near the "
         "old mill and count every grain of wheat that falls from carts on their slow way to market ").split()


@pytest.fixture(scope="session")
def prose():
    """Different texts that repeat no passage: words drawn by a fixed rule."""
    def make(seed: int, n: int) -> str:
        state, out = seed * 7919 + 13, []
        for _ in range(n):
            state = (state * 1103515245 + 12345) % 2**31
            out.append(PROSE[(state >> 8) % len(PROSE)] + str((state >> 16) % 50))
        return " ".join(out)
    return make
