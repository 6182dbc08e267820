"""Command line: build and query a stored index (run with spark-submit or python -m quire).

    python -m quire index   --books PATH [--text-dir] --out PATH --buckets N
    python -m quire catalog --lines PATH --out PATH --buckets N
    python -m quire search  --index PATH [--catalog PATH]
                            (--words 'w1+w2' [--title T] [--author A] [--from Y] [--to Y]
                             [--language L] | --requests FILE.jsonl) --out PATH
    python -m quire add     --books DIR --index PATH --ledger PATH
    python -m quire crawl   --pages PATH --downloads PATH --root PATH
    python -m quire ingest  --source DIR --index PATH --ledger PATH --checkpoint PATH
    python -m quire compact --index PATH --ledger PATH --out PATH --buckets N
    python -m quire merge   --index PATH --ledger PATH [--fan N] [--grace SECONDS]
    python -m quire nbooks  --ledger PATH
    python -m quire forward --books PATH [--text-dir] --out PATH --buckets N
    python -m quire fragment --book ID --word-pos N [--forward PATH [--radius R]]

``catalog`` writes the parsed catalogue and the n-gram index of its texts (``OUT/texts``), which
``search --words`` uses.  ``fragment`` prints the fixed sentence, or with a forward index the words
around the place.  ``crawl`` takes fetched book pages (href, html) and fetched texts (download_url, html) to
metadata log, book store and index under ROOT.  ``merge`` merges the runs of an incremental index level by level and removes folders replaced longer ago
than the grace.  ``add`` indexes the <id>.txt files of a folder that the ledger does not list yet, and prints
how many books were new.  ``search --words`` splits on '+' like the reference route; a request file holds one JSON
object per line: {"query_id": 1, "words": [...], "title": ..., "year_from": ..., ...}.
Results are JSON lines {"query_id", "bookId", "positions": {word: [pos, ...]}} — the
reference's result object plus the request id.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quire.constants import FRAGMENT_STUB


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quire")
    sub = p.add_subparsers(dest="cmd", required=True)
    i = sub.add_parser("index")
    i.add_argument("--books", required=True)
    i.add_argument("--text-dir", action="store_true", help="BOOKS is a folder of <id>.txt")
    i.add_argument("--id-col", default="doc_id")
    i.add_argument("--text-col", default="text")
    i.add_argument("--out", required=True)
    i.add_argument("--buckets", type=int, required=True)
    c = sub.add_parser("catalog")
    c.add_argument("--lines", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--buckets", type=int, required=True)
    s = sub.add_parser("search")
    s.add_argument("--index", required=True)
    s.add_argument("--catalog")
    g = s.add_mutually_exclusive_group(required=True)
    g.add_argument("--words")
    g.add_argument("--requests")
    for crit in ("title", "author", "from", "to", "language"):
        s.add_argument(f"--{crit}")
    s.add_argument("--out", required=True)
    a = sub.add_parser("add")
    for name in ("books", "index", "ledger"):
        a.add_argument(f"--{name}", required=True)
    cr = sub.add_parser("crawl")
    for name in ("pages", "downloads", "root"):
        cr.add_argument(f"--{name}", required=True)
    st = sub.add_parser("ingest")
    for a in ("source", "index", "ledger", "checkpoint"):
        st.add_argument(f"--{a}", required=True)
    st.add_argument("--max-files", type=int, default=1000)
    cp = sub.add_parser("compact")
    for a in ("index", "ledger", "out"):
        cp.add_argument(f"--{a}", required=True)
    cp.add_argument("--buckets", type=int, required=True)
    m = sub.add_parser("merge")
    for name in ("index", "ledger"):
        m.add_argument(f"--{name}", required=True)
    m.add_argument("--fan", type=int, default=8)
    m.add_argument("--grace", type=float, default=7 * 24 * 3600)
    n = sub.add_parser("nbooks")
    n.add_argument("--ledger", required=True)
    w = sub.add_parser("forward")
    w.add_argument("--books", required=True)
    w.add_argument("--text-dir", action="store_true", help="BOOKS is a folder of <id>.txt")
    w.add_argument("--id-col", default="doc_id")
    w.add_argument("--text-col", default="text")
    w.add_argument("--out", required=True)
    w.add_argument("--buckets", type=int, required=True)
    f = sub.add_parser("fragment")
    f.add_argument("--forward")
    f.add_argument("--radius", type=int, default=5)
    f.add_argument("--book", type=int, required=True)
    f.add_argument("--word-pos", type=int, required=True)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> object:
    args = _parser().parse_args(argv)
    if args.cmd == "fragment" and not args.forward:   # the reference's text route is a fixed sentence
        out = FRAGMENT_STUB % (args.word_pos, args.book)
        print(out)
        return out
    if spark is None:
        from pyspark import SparkConf
        from quire.session import get_session
        # spark-submit sets the master; a plain `python -m quire` runs locally
        master = None if SparkConf().contains("spark.master") else "local[*]"
        spark = get_session(master)
    if args.cmd == "fragment":
        from quire.sinks.forward_store import fragment_at
        out = [r["fragment"] for r in fragment_at(spark, args.forward, args.book, args.word_pos, args.radius).collect()]
        print("\n".join(out))
        return out
    if args.cmd in ("index", "forward"):
        from quire.plans.indexing import build_index
        from quire.sinks.forward_store import save_forward_table
        from quire.sinks.index_store import save_index_table
        from quire.sources.books import books_from_files, books_from_table
        books = (books_from_files(spark, args.books) if args.text_dir else
                 books_from_table(spark.read.parquet(args.books), args.id_col, args.text_col))
        if args.cmd == "forward":
            return save_forward_table(books, args.out, args.buckets)
        return save_index_table(build_index(books), args.out, args.buckets)
    if args.cmd == "catalog":
        from quire.operators.catalog import load_catalog
        from quire.sinks.criteria_store import save_criteria_index
        from quire.sinks.index_store import open_catalog_table, save_catalog_table
        from quire.sources.catalog import read_catalog_lines
        name = save_catalog_table(load_catalog(read_catalog_lines(spark, args.lines)),
                                  args.out, args.buckets)
        save_criteria_index(open_catalog_table(spark, args.out), f"{args.out}/texts", args.buckets)
        return name
    if args.cmd == "search":
        return _search(spark, args)
    if args.cmd == "add":
        from quire.plans.indexing import index_new_books
        from quire.sources.books import books_from_files
        n = index_new_books(books_from_files(spark, args.books), args.index, args.ledger).count()
        print(n)
        return n
    if args.cmd == "crawl":
        from quire.plans.crawl_flow import crawl_to_index
        n = crawl_to_index(spark.read.parquet(args.pages), spark.read.parquet(args.downloads), args.root).count()
        print(n)
        return n
    if args.cmd == "ingest":
        from quire.streaming.ingest import start_stream_index
        q = start_stream_index(spark, args.source, args.index, args.ledger, args.checkpoint,
                               max_files_per_trigger=args.max_files)
        q.awaitTermination()
        return q.id
    if args.cmd == "compact":
        from quire.plans.indexing import compact_index
        return compact_index(args.index, args.ledger, args.out, args.buckets, spark)
    if args.cmd == "merge":
        from quire.sinks.index_store import read_ledger
        from quire.sinks.run_levels import expire_runs, merge_runs
        n = merge_runs(spark, args.index, read_ledger(spark, args.ledger), args.fan)
        print(f"{n} merges, {expire_runs(spark, args.index, args.grace)} folders removed")
        return n
    if args.cmd == "nbooks":
        from quire.operators.ledger import ledger_size
        from quire.sinks.index_store import read_ledger
        n = ledger_size(read_ledger(spark, args.ledger)).first()["nbooks"]
        print(n)
        return n
    raise SystemExit(f"unknown command {args.cmd}")


def _search(spark: SparkSession, args) -> str:
    from quire.functions.text import parse_query
    from quire.operators import search as S
    from quire.sinks.criteria_store import open_criteria_index
    from quire.sinks.index_store import current_version, open_catalog_table, open_index_table
    index = open_index_table(spark, args.index)
    catalog = open_catalog_table(spark, args.catalog) if args.catalog else None
    if args.words is not None:
        # one literal request: only the files of its words and of its criteria's grams are read
        texts = f"{args.catalog}/texts"
        texts = open_criteria_index(spark, texts) if args.catalog and current_version(spark, texts) else None
        words = spark.range(1).select(parse_query(F.lit(args.words)).alias("w")).first()["w"]
        res = S.search(spark, index, words, args.title, args.author, getattr(args, "from"), args.to, args.language,
                       catalog=catalog, texts=texts).withColumn("query_id", F.lit(0).cast("bigint"))
    else:
        requests = S.with_criteria_columns(
            spark.read.schema(S.REQUEST_SCHEMA).json(args.requests))
        res = S.search_batch(index, requests, catalog)
    res.select("query_id", F.col("book_id").alias("bookId"), "positions") \
        .write.mode("overwrite").json(args.out)
    return args.out


if __name__ == "__main__":
    main(sys.argv[1:])
