import pytest

from tessera.llm.common import reach

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def _workers_import_this(spark):
    reach(spark)


def documents(spark, rows, extra=()):
    """Documents from (doc_id, text[, lang]) with clashing extra columns if named."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None, *["x"] * len(extra)) for r in rows]
    return spark.createDataFrame(full, ", ".join([DOCS, *(f"`{c}` string" for c in extra)]))
