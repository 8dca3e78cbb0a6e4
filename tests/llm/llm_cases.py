"""Documents with the cases every operator must bear, and table helpers."""

LONG = ("alpha beta gamma delta " * 20_000) + "x" * 50_000
ENGLISH = "the house is near the river and the children walk along the water every morning before school"
GERMAN = "das haus steht am fluss und die kinder gehen jeden morgen vor der schule am wasser entlang"
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, label string, id string, "
          "score string, fp string, row string, count string, hits string, rule string")


def edge_rows():
    """(doc_id, text, lang, source, n_chars, clashing columns ...)."""
    texts = [(0, ENGLISH, "en", "a"), (1, ENGLISH, "en", "a"), (1, ENGLISH, "en", "a"), (2, GERMAN, "de", "b"),
             (3, None, "en", "a"), (4, "", "de", "b"), (5, " \t\n ", None, None), (None, ENGLISH + " twice", "en", "b"),
             (None, None, None, None), (6, LONG, "en", "a"), (7, "12 345 !! ??", "en", "c"), (8, "Ünïcödé Straße 日本語", "de", "c"),
             (9, "one", "en", "a"), (10, "two words", "en", "a"), (11, "﻿​\x00\x1f", None, "a")]
    return [(i, t, lang, source, len(t) if t else None, *["clash"] * 7, None) for i, t, lang, source in texts]


def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def save(tmp, **tables):
    """Tables as a folder that the queries read."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{tmp}/{name}.parquet")
    return str(tmp)
