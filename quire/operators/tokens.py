"""Token positions and stopword removal (DataFrame level)."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.constants import STOPWORDS
from quire.functions.text import tokenize
from quire.operators.sizing import broadcast_if_small

Tokenizer = Callable[[Column], Column]


def token_positions(books: DataFrame, tokenizer: Tokenizer = tokenize,
                    id_col: str = "book_id", text_col: str = "text") -> DataFrame:
    """(book_id, pos INT, word) for every token, numbered from 0 over the whole book.

    Numbering happens before stopword removal, so stopwords consume positions.
    ``tokenizer`` is any Column -> ARRAY<STRING> function (the pluggable tokenizer port);
    the default is the native expression in :func:`quire.functions.tokenize`.
    """
    return books.select(F.col(id_col).alias("book_id"),
                        F.posexplode(tokenizer(F.col(text_col))).alias("pos", "word"))


def is_stopword(word, stopwords=STOPWORDS) -> Column:
    """Membership in the stopword set; a literal IN-set, compiled to a hash-set lookup."""
    w = F.col(word) if isinstance(word, str) else word
    return w.isin(*stopwords)


def remove_stopwords(tokens: DataFrame, stopwords=STOPWORDS) -> DataFrame:
    """Drop stopword tokens; positions of the remaining tokens are unchanged.

    ``stopwords`` is the fixed word list (an in-set predicate inside the scan stage); a
    one-column DataFrame of words is also accepted and is anti-joined.
    """
    if isinstance(stopwords, DataFrame):
        sw = stopwords.select(F.col(stopwords.columns[0]).alias("word")).distinct()
        return tokens.join(broadcast_if_small(sw), "word", "left_anti") \
            .select(*tokens.columns)
    return tokens.filter(~is_stopword("word", stopwords))


def index_tokens(books: DataFrame, tokenizer: Tokenizer = tokenize,
                 stopwords=STOPWORDS) -> DataFrame:
    """Token positions with stopwords removed: the input of the postings build."""
    return remove_stopwords(token_positions(books, tokenizer), stopwords)
