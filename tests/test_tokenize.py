from pyspark.sql import functions as F

from support import rows
from quire.functions.text import java_trim, strip_header, tokenize
from quire.operators.tokens import index_tokens, token_positions


def _books(spark, *texts):
    return spark.createDataFrame([(i + 1, t) for i, t in enumerate(texts)],
                                 "book_id BIGINT, text STRING")


def test_positions_count_stopwords_and_start_at_zero(spark):
    b = _books(spark, "The whale and the sea")
    assert rows(token_positions(b), "pos", "word") == [
        (0, "the"), (1, "whale"), (2, "and"), (3, "the"), (4, "sea")]
    assert rows(index_tokens(b), "pos", "word") == [(1, "whale"), (4, "sea")]


def test_leading_punctuation_adds_no_token(spark):
    b = _books(spark, "...  ¡Hola! (whale)")
    assert rows(token_positions(b), "pos", "word") == [(0, "hola"), (1, "whale")]


def test_apostrophes_and_digits(spark):
    b = _books(spark, "don't don’t r2d2 whale's")
    got = rows(token_positions(b), "pos", "word")
    # ASCII apostrophe stays inside the word, the curly one splits it; digits vanish
    assert got == [(0, "don't"), (1, "don"), (2, "t"), (3, "r"), (4, "d"), (5, "whale's")]
    # "don't", "don", "t" and "d" are stopwords: removed, but their positions are used
    assert rows(index_tokens(b), "pos", "word") == [(3, "r"), (5, "whale's")]


def test_kept_symbols(spark):
    b = _books(spark, "a#b c@d e~f «g» h–i")
    words = [w for _, w in rows(token_positions(b), "pos", "word")]
    assert words == ["a#b", "c@d", "e~f", "«g»", "h–i"]


def test_whole_text_equals_line_by_line(spark):
    text = "First line, here.\nSecond\tline -- more\r\nthird"
    whole = spark.createDataFrame([(text,)], "t STRING").select(tokenize("t").alias("w"))
    per_line = []
    for line in text.splitlines():
        per_line += spark.createDataFrame([(line,)], "t STRING").select(
            tokenize("t").alias("w")).first()["w"]
    assert whole.first()["w"] == per_line


def test_strip_header(spark):
    df = spark.createDataFrame([
        (1, "junk *** START *** \n  body text  \n"),
        (2, "no marker here  "),
        (3, "*** open\nclose *** body"),
        (4, "a ***x*** b ***y*** c"),
    ], "id INT, text STRING")
    got = dict(rows(df.select("id", strip_header("text").alias("s"))))
    assert got[1] == "body text"
    assert got[2] == "no marker here  "        # untouched, not trimmed
    assert got[3] == "*** open\nclose *** body"  # marker must close on its own line
    assert got[4] == "b ***y*** c"              # only the first marker is cut


def test_java_trim_strips_control_chars(spark):
    df = spark.createDataFrame([("\t\x01 x \n\x0b",)], "t STRING")
    assert df.select(java_trim("t").alias("t")).first()["t"] == "x"


def test_break_class_equals_break_characters(spark):
    """The regex class and the plain character set agree on every BMP character below
    the surrogates (Java's \\d is ASCII only)."""
    from quire.constants import TOKEN_BREAK_CHARS, TOKEN_BREAK_CLASS
    chars = spark.range(0, 0xD800).selectExpr(
        "cast(id as int) as c", "decode(unhex(lpad(hex(id), 4, '0')), 'utf-16be') as ch")
    bad = chars.filter(F.regexp_replace("ch", TOKEN_BREAK_CLASS, " ")
                       != F.translate("ch", TOKEN_BREAK_CHARS, " " * len(TOKEN_BREAK_CHARS)))
    assert bad.count() == 0
