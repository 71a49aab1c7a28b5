"""Row kernel that describes a text by seven numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TEXT_DESCRIPTORS = [
    "n_chars",
    "n_words",
    "n_lines",
    "n_digits",
    "n_upper",
    "n_punct",
    "mean_word_len",
]


def text_descriptors(c: Column | str) -> Column:
    """Struct of the seven text numbers; null for a null text.

    Classes are ASCII only: words are runs without space, tab or line break, and
    punctuation is any printable ASCII character that is not a letter, digit or space.
    """
    text = F.col(c) if isinstance(c, str) else c
    counts = F.struct(
        F.length(text).alias("n_chars"),
        F.regexp_count(text, F.lit(r"[^ \t\r\n]+")).alias("n_words"),
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).alias("n_lines"),
        F.regexp_count(text, F.lit("[0-9]")).alias("n_digits"),
        F.regexp_count(text, F.lit("[A-Z]")).alias("n_upper"),
        F.regexp_count(text, F.lit(r"[!-/:-@\[-`{-~]")).alias("n_punct"),
        F.regexp_count(text, F.lit(r"[ \t\r\n]")).alias("n_blank"),
    )

    def described(n: Column) -> Column:
        solid = (n["n_chars"] - n["n_blank"]).cast("double")
        mean = F.coalesce(F.try_divide(solid, n["n_words"]), F.lit(0.0))
        return F.struct(*[n[name] for name in TEXT_DESCRIPTORS[:-1]], mean.alias("mean_word_len"))

    # The lambda binds the counts, so each is made once.
    return F.when(text.isNotNull(), F.transform(F.array(counts), described)[0])
