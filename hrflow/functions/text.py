"""Word tokens of a message.

The reference upper-cases the message and takes ``\\b\\w+\\b`` words with Python's
Unicode ``\\w``. Java's ``\\w`` is ASCII-only, so the class is spelled out.
"""

from pyspark.sql import Column, functions as F

# Fixed value: letters, digits and underscore in any script.
WORD_PATTERN = r"[\p{L}\p{N}_]+"


def word_tokens(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract_all(F.upper(c), F.lit(WORD_PATTERN), 0)
