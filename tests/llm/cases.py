"""Awkward rows that every operator must take: nulls, empties, long texts, ties, repeats, extra columns."""

LONG = "word " * 40_000
TEXTS = [None, "", " ", "a", "same text of some words here", "same text of some words here", "é😀 ünï ", LONG,
         "x" * 5_000, "line\nline\nline"]


def documents(spark, texts=TEXTS, ids=None):
    """documents-like rows: ids repeat and are null at the end; extra columns clash with output names."""
    ids = ids if ids is not None else [*range(len(texts) - 2), 3, None]
    rows = [(i, t, "en", "s", None, "clash", 7, "clash") for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, "
              "score string, spans int, fingerprint string")
