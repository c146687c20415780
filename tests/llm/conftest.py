import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture()
def docs(spark):
    """Build a documents table from (doc_id, text[, lang[, source]])."""
    def make(rows, **extra):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0",
                 None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for name, value in extra.items():  # columns whose names clash with the operators' own
            from pyspark.sql import functions as F
            df = df.withColumn(name, F.lit(value))
        return df
    return make


CLASHING = dict(row="x", t="x", i=1, w="x", k=2, h=3, fp=4, kept=True, lang_pred="x", score=0.5, component_id=9)


@pytest.fixture()
def clashing():
    return dict(CLASHING)
