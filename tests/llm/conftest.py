import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[2]))
sys.path.insert(0, str(Path(__file__).parent))

FIELDS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Build a documents table from (doc_id, text) or (doc_id, text, lang)."""

    def build(*rows):
        filled = [
            (r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows
        ]
        return spark.createDataFrame(filled, FIELDS)

    return build


def words(start: int, count: int) -> str:
    """Text of words that occur nowhere else."""
    letters = str.maketrans("0123456789", "abcdefghij")
    return " ".join(f"w{i}".translate(letters) for i in range(start, start + count))
