"""Tables with awkward rows for the tests of this folder."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string"
EDGE = [None, "", " \n\t", "word", "a b c d e f", "a b c d e f", "x " * 30000, "é ü ñ", "The same line is here again.\nThe same line is here again."]


def docs(spark, texts, ids=None):
    rows = [(i, t, "en", f"s{k % 3}" if k % 4 else None, len(t or ""), "clash") for k, (i, t) in enumerate(zip(ids or range(len(texts)), texts, strict=True))]
    return spark.createDataFrame(rows, DOCS)
