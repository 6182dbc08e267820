"""A custom tokenizer through the pluggable tokenizer port, as a native expression.

Any ``Column -> ARRAY<STRING>`` function can replace the default tokenizer; this one
splits lower-cased text into runs of Unicode letters (digits and punctuation separate
words).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def letter_run_tokenizer(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), F.lit(0))
