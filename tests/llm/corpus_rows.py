"""Small document tables for the corpus operators, with the odd cases every operator must bear."""

from pyspark.sql import types as T

#: Column names operators use inside; documents may carry them too.
CLASHING = ["h", "sha", "fp", "key", "size", "kept", "score", "level", "cuts", "n", "doc", "place", "gone_id", "_sha", "_fp", "_cuts", "_cut_id", "text_crc32"]

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in CLASHING]
)


def table(spark, rows):
    """A documents table of (doc_id, text) rows with columns of clashing names, some null."""
    full = [(i, t, None, *[c if n % 2 else None for n, c in enumerate(CLASHING)]) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


LONG = " ".join(f"w{i % 997}x{i % 31}" for i in range(60_000))

#: Nulls, empties, blanks, ties, repeated rows, one very long text, non-ASCII text.
ODD = [
    (1, "Alpha beta gamma delta epsilon zeta"),
    (2, "Alpha  beta gamma\tdelta epsilon zeta"),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, LONG),
    (7, LONG),
    (None, "Alpha beta gamma delta epsilon zeta"),
    (None, None),
    (8, "ça été — naïve Ünïcode ß 漢字 \U0001f600 words here"),
    (9, "x"),
    (9, "x"),
    (10, "x"),
]


def read(spark, sf, name):
    return spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet")


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
