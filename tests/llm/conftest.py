import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents(doc_id, text, lang, source, n_chars) from (doc_id, text[, lang, source]) tuples, with
    extra columns whose names clash with the operators' own."""
    schema = T.StructType.fromDDL("doc_id long, text string, lang string, source string, n_chars long, "
                                  "rid long, id string, kept string, n_words string, row string, k string, size string")

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or ""),
                 7, "x", "x", "x", "x", "x", "x") for r in rows]
        return spark.createDataFrame(full, schema)

    return make
