"""Random text as a column expression (the random-string source, S3/X3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kpool.functions.tags import draw

# Strings are 1..10 letters, each uniform over 'a'..'z'.
MIN_LEN = 1
MAX_LEN = 10
ALPHABET_SIZE = 26
FIRST_LETTER = 97  # 'a'


def random_string(seed: int, id_text: Column) -> Column:
    """A seeded random string for a row identity: length uniform in 1..10,
    letters uniform a..z.  ``id_text`` is the row's identity as text."""
    length = draw(seed, "len", id_text, bound=MAX_LEN - MIN_LEN + 1) + MIN_LEN
    letters = F.transform(
        F.sequence(F.lit(1).cast("bigint"), length),
        lambda i: F.char(F.lit(FIRST_LETTER) + draw(seed, "letter", id_text, i, bound=ALPHABET_SIZE)),
    )
    return F.array_join(letters, "")
