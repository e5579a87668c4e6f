import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def duck():
    from oracle_check import duck_connection
    return duck_connection("/root/testdata/sf0.001")


@pytest.fixture
def documents(spark):
    """Rows ``(doc_id, text[, lang[, source]])`` as a documents table, with
    extra columns whose names the operators use inside."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s",
                 len(r[1] or ""), 7, "x", 1) for r in rows]
        return spark.createDataFrame(
            full, DOCUMENTS + ", key int, kept string, size int").repartition(3)
    return make
