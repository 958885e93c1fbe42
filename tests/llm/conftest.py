import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent.parent
sys.path[:0] = [str(ROOT)]

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, source)``, over several partitions."""

    def make(rows, extra=""):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", None if r[1] is None else len(r[1])) for r in rows]
        made = spark.createDataFrame(full, DOCS).repartition(3)
        for name in extra.split():
            made = made.withColumn(name, made["doc_id"])
        return made

    return make
