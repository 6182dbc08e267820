from pyspark.sql import functions as F

from support import rows
from quire.functions.metadata import format_metadata_line, release_year
from quire.operators.catalog import load_catalog, parse_catalog


def _lines(spark, *lines):
    return spark.createDataFrame([(i, l) for i, l in enumerate(lines)],
                                 "line_no BIGINT, line STRING")


def test_format_then_parse_roundtrip(spark):
    df = spark.createDataFrame([(7, "Moby Dick", "Herman Melville", "Oct 18, 1851", "English")],
                               "id INT, t STRING, a STRING, d STRING, l STRING")
    line = df.select(format_metadata_line("id", "t", "a", "d", "l").alias("line"),
                     F.lit(0).alias("line_no"))
    assert line.first()["line"] == ("ID: 7, Title: Moby Dick, Author: Herman Melville, "
                                     "Release Date: Oct 18, 1851, Language: English")
    p = parse_catalog(line).first()
    assert (p.book_id, p.title, p.author, p.date, p.language) == (
        7, "Moby Dick", "Herman Melville", "Oct 18, 1851", "English")


def test_commas_truncate_and_make_spurious_keys(spark):
    p = parse_catalog(_lines(spark, "ID: 3, Title: War, Peace: A Tale, Author: Leo")).first()
    assert p.title == "War"
    assert p.fields["Peace"] == "A Tale"
    assert p.author == "Leo"


def test_date_alternative_cuts_title(spark):
    p = parse_catalog(_lines(spark, "ID: 4, Title: July 4, 1776 story, Author: X")).first()
    assert p.title == "July 4, 1776"


def test_duplicate_key_last_wins_and_missing_id(spark):
    p = rows(parse_catalog(_lines(spark, "ID: 5, Title: A, Title: B", "Title: orphan",
                                  "ID: x1, Title: bad")), "book_id", "title")
    assert (5, "B") in p
    assert (-1, "orphan") in p
    assert (None, "bad") in p


def test_duplicate_id_last_line_wins_entirely(spark):
    lines = _lines(spark, "ID: 9, Title: Old, Author: Someone, Language: French",
                   "ID: 9, Title: New", "Title: no id")
    cat = load_catalog(lines)
    assert rows(cat, "book_id", "title", "author", "language") == [(9, "New", None, None)]


def test_release_year_lenient(spark):
    df = spark.createDataFrame([(d,) for d in [
        "Oct 18, 1851", "October 1, 1993", "Feb 31, 2000", "Dec 32, 1999", "jan 5, 2001",
        "Unknown", "Sept 5, 2001", "Jan 0, 2000", "Mar 3, 2004 extra"]], "d STRING")
    got = [r[0] for r in df.select(release_year("d")).collect()]
    assert got == [1851, 1993, 2000, 2000, 2001, None, None, 1999, 2004]


def test_catalog_log_append_and_read_back_last_wins(spark):
    import time
    from quire.session import work_path
    from quire.sinks.books_store import append_catalog_lines
    from quire.sources.catalog import read_catalog_lines
    log = work_path(spark, "t-catalog-log")
    first = spark.createDataFrame([("ID: 1, Title: Old One",), ("ID: 2, Title: Two",)], "line STRING")
    append_catalog_lines(first.coalesce(1), log)
    time.sleep(1.2)   # the second run's files are newer
    second = spark.createDataFrame([("ID: 1, Title: New One",), ("ID: 1, Title: Newest",)],
                                   "line STRING")
    append_catalog_lines(second.coalesce(1), log)
    cat = load_catalog(read_catalog_lines(spark, log))
    assert rows(cat, "book_id", "title") == [(1, "Newest"), (2, "Two")]


def test_last_wins_holds_across_file_splits(spark):
    """One large log split into many tasks (and several splits packed per task): the
    order key (file, split start, row) still makes the last line of an id win."""
    import os
    from quire.session import work_path
    from quire.sources.catalog import read_catalog_lines
    folder = work_path(spark, "t-split-log")
    os.makedirs(folder)
    lines = [f"ID: {i % 500}, Title: t{i}, Author: a" for i in range(20000)]
    with open(os.path.join(folder, "log.txt"), "w") as f:
        f.write("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        df = read_catalog_lines(spark, folder)
        assert df.rdd.getNumPartitions() > 10
        got = {r.book_id: r.title for r in load_catalog(df).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == 500
    assert all(got[i] == f"t{19500 + i}" for i in range(500))
