import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) tuples, dealt over a few partitions."""
    def build(rows, parts=3):
        full = [(r[0], r[1], "xx", r[2] if len(r) > 2 else "s", None) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(parts)
    return build
