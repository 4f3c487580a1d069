"""Rows that every operator must handle: nulls, empty and long texts, ties, repeats, clashing columns."""

LONG = " ".join(f"word{i % 977} of{i % 31}" for i in range(20_000))
PLAIN = "The quick brown fox jumps over the lazy dog while the rain falls on the plain of the old town " * 4

TEXTS = [
    (1, PLAIN),
    (2, None),
    (3, ""),
    (4, " \n\t \n"),
    (5, LONG),
    (6, PLAIN),
    (6, PLAIN),
    (None, "a null id with some words in it"),
    (None, None),
    (7, "one"),
    (8, "été Ünï 漢字   wide space  two  spaces\r\n"),
]


def docs(spark, rows=TEXTS):
    """Extra columns are named like things that operators add."""
    full = [(i, t, "en", f"s{(i or 0) % 3}" if i != 3 else None, len(t or ""), 0, "x", True) for i, t in rows]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, fp long, path string, kept boolean")


def empty(spark):
    return docs(spark, [])
