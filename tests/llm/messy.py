"""Rows every operator has to bear: NULLs, empty and long texts, repeats, clashing names."""

from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977}" for i in range(60_000))
ROWS = [
    (1, "Alpha beta\ngamma delta epsilon zeta", "en", "a"),
    (1, "Alpha beta\ngamma delta epsilon zeta", "en", "a"),  # a repeated row
    (2, None, None, None),
    (3, "", "en", "a"),
    (4, " \t\n\x0b\x0c\r ", "fr", "b"),
    (5, "!!! ... 123 \n\n", "de", "b"),
    (6, LONG, "en", "a"),
    (7, LONG + " end", "en", None),
    (8, "Größe naïve çà 漢字 \U0001f600 x", "de", "c"),
    (8, "another text under the same id", "en", "c"),
    (None, "a text without an id", "en", "a"),
    (None, "a second text without an id", "en", "a"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"
# Names that operators use for results or inside.
CLASHES = (
    "n_lines n_dropped kept_text score lang_pred fingerprint leaks n_words n_removed id key "
    "words bucket label u v sig _n"
).split()


def documents(spark, rows=None, clashes=True):
    df = spark.createDataFrame(ROWS if rows is None else rows, SCHEMA)
    for name in CLASHES if clashes else []:
        df = df.withColumn(name, F.lit(f"given {name}"))
    return df
