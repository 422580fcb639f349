import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture
def make_docs(spark):
    def make(rows, extra=()):
        """Documents from (doc_id, text[, lang]); ``extra`` columns are added
        with a constant, to clash with names an operator uses inside."""
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for c in extra:
            from pyspark.sql import functions as F
            df = df.withColumn(c, F.lit("clash"))
        return df
    return make
