import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
#: Names that the operators use inside or return.
CLASHING = ["size", "shard", "slot", "n", "h", "uid", "row", "piece", "label", "draw", "key", "bucket", "score", "keep",
            "grp", "node", "copies", "target", "pos", "line", "th", "doc", "id", "length", "start", "rank"]


def docs_frame(spark, rows):
    """rows: (doc_id, text[, lang[, source]])"""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "src0",
             len(r[1]) if r[1] is not None else None) for r in rows]
    return spark.createDataFrame(full, DOCS)


def with_clashes(df):
    from pyspark.sql import functions as F
    for i, c in enumerate(CLASHING):
        df = df.withColumn(c, F.lit(i))
    return df


PROSE = ("The quick brown fox jumps over the lazy dog near the river bank while seven small birds sing in the old "
         "tree and the farmer walks home to his house with a basket of red apples for the children")


@pytest.fixture(scope="session")
def nasty(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows."""
    long = " ".join(f"word{i % 977} goes{i}" for i in range(60_000))
    rows = [(1, PROSE), (2, PROSE), (3, PROSE.upper()), (4, None), (5, ""), (6, " \n\t "), (7, "a"),
            (8, "Ünïcode ÄÖÜ straße\nπ 中文 \x0b x"), (9, long), (10, PROSE, None, None), (None, PROSE), (None, None, None, None),
            (11, "x y z"), (11, "x y z"), (12, "one\ntwo\n\n"), (13, "!!! ??? 123"), (14, "a b   c"),
            (15, PROSE + " today"), (16, "\n".join([PROSE] * 4)), (9_007_199_254_740_993, "big id " + PROSE)]
    return docs_frame(spark, rows)


@pytest.fixture(scope="session")
def empty(spark):
    return docs_frame(spark, [])


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def python_rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]
