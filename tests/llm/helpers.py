"""Rows with nulls, empty and very long texts, ties, repeats and clashing extra columns."""

from pyspark.sql import functions as F

CLASH = ["score", "n", "sid", "key", "block", "uid", "size", "label", "sketch", "node", "length", "offset", "ids", "seg", "v", "slot", "tie"]


def frame(spark, rows):
    """documents-like frame with extra columns whose names the operators use inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASH})


def odd_rows():
    long = " ".join(f"word{i % 977} und{i % 13}" for i in range(30_000))
    texts = [
        None, "", "   ", "\n\n", "a", "a b c", "Hello world, it's 5 o'clock", "Hello world, it's 5 o'clock",
        "x<|endoftext|> y<|endoftext|>", "tab\t tab \t\tq  ", "é À 日本語 テスト 123 ½", "\U0001f600 emoji \U0001f468‍\U0001f469 end",
        "foo   bar \n baz", "a\x1fb \x85 c\xa0d", "1234 5678 !!", "The MIT License\n\nReleased under the MIT License.\nend", long, long,
    ]
    rows = [(10 * i, t, "en" if i % 3 else None, None if i % 4 else "s", None) for i, t in enumerate(texts)]
    return [*rows, rows[6], (None, "row without an id", None, None, None)]
