"""Small tables for the text operators: awkward rows beside a slice of the test documents."""

ROOT = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, score string, words string, __id string"
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
AWKWARD = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", "en", "a"), (4, "one", "en", None), (5, "one", "en", "b"),
    (6, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3, "en", "b"),
    (7, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3, "fr", "b"), (7, "second row of the same id", "fr", "b"),
    (8, LONG, "en", "c"), (9, LONG, "en", "c"), (10, "12 34 !!", "en", "c"), (None, "a row without an id", "en", "c"),
    (11, "Ä ß é 漢字 emoji \U0001f600 mixed words and text here to be read", "de", "c"),
]


def awkward(spark, rows=AWKWARD):
    """Rows with nulls, empty and very long texts, ties and repeated ids, and columns whose names operators use inside."""
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), "x", "y", "z", "q") for r in rows], SCHEMA)


def empty(spark):
    return awkward(spark, [])


def table(spark, name, root=ROOT):
    return spark.read.parquet(f"{root}/{name}.parquet")
