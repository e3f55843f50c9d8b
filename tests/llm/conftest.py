import pytest
from pyspark.sql import types as T

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def small(spark):
    """Builder of tables: rows of values and a schema string."""
    def make(rows, schema=DOCS):
        return spark.createDataFrame(rows, T._parse_datatype_string(schema) if isinstance(schema, str) else schema)
    return make


@pytest.fixture(scope="session")
def docs_of(small):
    """Documents from {doc_id: text}."""
    def make(texts, source="s"):
        return small([(i, t, "en", source, None if t is None else len(t)) for i, t in texts.items()])
    return make
