import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))


@pytest.fixture
def docs(spark):
    """Rows (doc_id, text) with other columns whose names operators also use."""
    def make(rows, id_type="bigint"):
        names = ["row", "id", "digest", "suspect", "key", "n", "kept"]
        schema = f"doc_id {id_type}, text string, " + ", ".join(f"`{c}` string" for c in names)
        return spark.createDataFrame([(*r, *names) for r in rows], schema)
    return make
