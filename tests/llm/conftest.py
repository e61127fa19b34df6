import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of():
    """Documents table from (doc_id, text, source) rows, with extra columns of clashing names."""
    def build(spark, rows):
        from pyspark.sql import functions as F
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        rows = [(i, t, None, s, None if t is None else len(t)) for i, t, s in rows]
        df = spark.createDataFrame(rows, schema)
        clash = ("key", "fp", "h", "w", "part", "rank", "length", "count", "hot", "spans", "th", "_host", "_t1", "quality_", "doc")
        return df.withColumns({c: F.lit("x") for c in clash})
    return build
