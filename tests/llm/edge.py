"""Rows that every operator has to take: nulls, empty and long texts, repeats, and extra columns with clashing names."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, id long, row string, gone string, root long, kind string"
LONG = " ".join(f"word{i % 977}x{i}" for i in range(40_000))
SENTENCE = "the quick brown fox jumps over the lazy dog near the old river bank today"


def rows(*texts):
    return [(i, t, None, "s", len(t or ""), 0.5, 7, "r", "g", 3, "k") for i, t in texts]


def documents(spark):
    made = rows((1, SENTENCE), (2, None), (3, ""), (4, " \n\t "), (5, LONG), (5, LONG), (6, SENTENCE), (6, SENTENCE), (7, "one"), (None, SENTENCE), (None, None), (8, "ünï " * 3))
    return spark.createDataFrame(made, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
