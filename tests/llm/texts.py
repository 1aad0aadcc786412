"""Awkward texts shared by the tests."""

AWKWARD = [
    None,
    "",
    " ",
    "a",
    "É İ ß K 中文字 🙂🙂 é",
    "x" * 5000,
    "tab\tand\nnew\r\nlines \x00\x01 control",
    "  many   spaces   ",
    "Don't you'll I've they're it's 12345 67,890.12 !!! ...",
    "one two three four five six seven eight nine ten eleven twelve " * 30,
]


def documents(spark, texts, **extra):
    rows = [(i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string")
