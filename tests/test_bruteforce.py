"""Brute-force checks on small generated fixtures: the Spark plans against plain Python
statements of the same rules."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quire.constants import STOPWORDS, TOKEN_BREAK_CLASS
from quire.functions.text import tokenize
from quire.operators import search as S
from quire.plans.indexing import build_index

JAVA_WS = re.compile(r"[ \t\n\x0b\f\r]+")
BREAK = re.compile(TOKEN_BREAK_CLASS)
ALPHABET = list("abcdeéñüxyz AB'’.,;:-_()!?\t\n\r\x0b\x0c\xa0#@~0123456789") + ["the ", " and "]


def py_tokens(text):
    return [w for w in JAVA_WS.split(BREAK.sub(" ", text.lower())) if w]


texts = st.lists(st.lists(st.sampled_from(ALPHABET), max_size=40).map("".join),
                 min_size=1, max_size=25)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts)
def test_tokenizer_matches_python_statement(spark, batch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(batch)], "i INT, t STRING")
    got = {r.i: r.w for r in df.select("i", tokenize("t").alias("w")).collect()}
    for i, t in enumerate(batch):
        assert got[i] == py_tokens(t), repr(t)


VOCAB = ["whale", "sea", "ship", "the", "and", "ahab", "sky", "wind"]
books_st = st.lists(st.lists(st.sampled_from(VOCAB), max_size=12), min_size=1, max_size=12)
reqs_st = st.lists(st.lists(st.sampled_from(VOCAB + ["", "Whale", "nope"]), max_size=4),
                   min_size=1, max_size=8)


def brute_force(books, requests):
    out = set()
    for q, words in enumerate(requests):
        if not words:
            continue
        for b, toks in enumerate(books):
            if all(w in toks and w not in STOPWORDS for w in set(words)):
                pos = {w: [i for i, t in enumerate(toks) if t == w] for w in set(words)}
                out.add((q, b, tuple(sorted((w, tuple(p)) for w, p in pos.items()))))
    return out


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(books_st, reqs_st)
def test_batch_search_matches_brute_force(spark, books, requests):
    bdf = spark.createDataFrame([(b, " ".join(t)) for b, t in enumerate(books)],
                                "book_id BIGINT, text STRING")
    postings = build_index(bdf, partitions=4).cache()
    req = S.make_requests(spark, [dict(query_id=q, words=w) for q, w in enumerate(requests)])
    expected = brute_force(books, requests)
    for index in (postings, S.index_over(postings)):
        got = {(r.query_id, r.book_id, tuple(sorted((k, tuple(v)) for k, v in r.positions.items())))
               for r in S.search_batch(index, req).collect()}
        assert got == expected
    postings.unpersist()


def test_hot_book_with_many_copies(spark):
    """One book id holding a third of all rows (re-delivered copies, some different):
    the index is the set union, and no exchange before the aggregation is keyed on the
    book id alone."""
    rows = [(i, f"word{i} common text {i % 7}") for i in range(1, 201)]
    rows += [(7, "hot copy whale sea") for _ in range(90)] + [(7, "hot whale ocean")] * 10
    df = spark.createDataFrame(rows, "book_id BIGINT, text STRING")
    post = build_index(df, partitions=8)
    got = {(r.word, r.book_id): r.positions for r in post.filter("book_id = 7").collect()}
    assert got[("hot", 7)] == [0]
    assert got[("whale", 7)] == [1, 2]        # {2} from one version, {1} from the other
    assert got[("sea", 7)] == [3]
    assert got[("ocean", 7)] == [2]
    plan = post._jdf.queryExecution().executedPlan().toString()
    exchanges = re.findall(r"Exchange (\w+)\(([^)]*)\)", plan)
    keyed = [cols for kind, cols in exchanges if kind == "hashpartitioning"]
    assert keyed and all("word" in cols for cols in keyed)


MONTHS3 = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
catalog_st = st.lists(st.tuples(
    st.sampled_from(["Moby Dick", "Sea Tales", "Ship Log", "Whale Song", "Dry Land"]),
    st.sampled_from(["Melville", "Anon", "Cook", "SEA Writer"]),
    st.one_of(st.just("Unknown"), st.tuples(st.integers(0, 11), st.integers(1, 28),
                                            st.integers(1800, 2020))),
    st.sampled_from(["English", "French", "Unknown"]),
    st.booleans()), min_size=12, max_size=12)
crit_st = st.lists(st.tuples(
    st.lists(st.sampled_from(VOCAB), min_size=1, max_size=3),
    st.one_of(st.none(), st.sampled_from(["sea", "MOBY", "", "log"])),
    st.one_of(st.none(), st.sampled_from(["anon", "sea", "COOK"])),
    st.one_of(st.none(), st.integers(1800, 2020).map(str)),
    st.one_of(st.none(), st.integers(1800, 2020).map(str)),
    st.one_of(st.none(), st.sampled_from(["english", "fr", "x"]))), min_size=1, max_size=6)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(books_st, catalog_st, crit_st)
def test_criteria_search_matches_brute_force(spark, books, cat_rows, reqs):
    from quire.operators.catalog import load_catalog
    bdf = spark.createDataFrame([(b, " ".join(t)) for b, t in enumerate(books)],
                                "book_id BIGINT, text STRING")
    postings = build_index(bdf, partitions=4).cache()
    meta, lines = {}, []
    for b, (title, author, date, lang, present) in enumerate(cat_rows[:len(books)]):
        if not present:
            continue            # a book without catalogue data
        d = date if date == "Unknown" else f"{MONTHS3[date[0]]} {date[1]}, {date[2]}"
        lines.append((len(lines), f"ID: {b}, Title: {title}, Author: {author}, "
                                   f"Release Date: {d}, Language: {lang}"))
        meta[b] = (title, author, None if date == "Unknown" else date[2], lang)
    catalog = load_catalog(spark.createDataFrame(lines, "line_no BIGINT, line STRING"))
    requests = [dict(query_id=q, words=w, title=t, author=a, year_from=f, year_to=to,
                     language=lg) for q, (w, t, a, f, to, lg) in enumerate(reqs)]
    got = {(r.query_id, r.book_id) for r in
           S.search_batch(postings, S.make_requests(spark, requests), catalog).collect()}

    def ok(b, r):
        crit = [r[c] for c in ("title", "author", "year_from", "year_to", "language")]
        if all(c is None for c in crit):
            return True
        if b not in meta:
            return False
        title, author, year, lang = meta[b]
        checks = [(r["title"], lambda v: v.lower() in title.lower()),
                  (r["author"], lambda v: v.lower() in author.lower()),
                  (r["language"], lambda v: v.lower() in lang.lower()),
                  (r["year_from"], lambda v: year is not None and year >= int(v)),
                  (r["year_to"], lambda v: year is not None and year <= int(v))]
        return all(v is None or f(v) for v, f in checks)

    expected = {(q, b) for q, r in enumerate(requests) for b, toks in enumerate(books)
                if all(w in toks and w not in STOPWORDS for w in set(r["words"])) and ok(b, r)}
    assert got == expected
    postings.unpersist()


PAIR = re.compile(r"(\w+)\s*:\s*((?:\w+\s+\d{1,2},\s+\d{4})|[^,]+)", re.ASCII)
piece_st = st.sampled_from([
    "ID: 3", "ID: 12", "ID: x9", "Title: Moby, Dick", "Title: July 4, 1776 story",
    "Author: A: B", "Release Date: Oct 18, 1851", "Release Date: Unknown", "Language: English",
    "Title: Second", " junk ", "Language:French", "ID:7"])
lines_st = st.lists(st.lists(piece_st, min_size=1, max_size=6).map(", ".join),
                    min_size=1, max_size=15)


def py_parse(line):
    book, fields = -1, {}
    for k, v in PAIR.findall(line):
        if k == "ID":
            book = int(v) if re.fullmatch(r"[+-]?[0-9]+", v) else None
        else:
            fields[k] = v
    return book, fields


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines_st)
def test_catalog_parse_and_last_wins_match_python(spark, lines):
    from quire.operators.catalog import load_catalog, parse_catalog
    df = spark.createDataFrame(list(enumerate(lines)), "line_no BIGINT, line STRING")
    got = {r.line_no: (r.book_id, dict(r.fields)) for r in parse_catalog(df).collect()}
    assert got == {i: py_parse(l) for i, l in enumerate(lines)}
    last = {}
    for l in lines:
        b, f = py_parse(l)
        if b is not None and b >= 0:
            last[b] = f
    cat = {r.book_id: (r.title, r.author, r.date, r.language) for r in load_catalog(df).collect()}
    assert cat == {b: (f.get("Title"), f.get("Author"), f.get("Date"), f.get("Language"))
                   for b, f in last.items()}


FULL = ["January", "February", "March", "April", "May", "June", "July", "August",
        "September", "October", "November", "December"]
date_st = st.tuples(st.integers(0, 11), st.booleans(), st.sampled_from([str.lower, str.upper, str]),
                    st.integers(0, 99), st.integers(1000, 9000))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(date_st, min_size=1, max_size=40))
def test_lenient_year_matches_calendar_arithmetic(spark, dates):
    import datetime
    from quire.functions.metadata import release_year
    texts, expected = [], []
    for m, full, case, day, year in dates:
        name = case(FULL[m] if full else FULL[m][:3])
        texts.append(f"{name} {day}, {year}")
        d = datetime.date(year, m + 1, 1) + datetime.timedelta(days=day - 1)
        expected.append(d.year)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, d STRING")
    got = [r.y for r in df.select("i", release_year("d").alias("y")).orderBy("i").collect()]
    assert got == expected


JAVA_MARKER = re.compile(r"\*\*\*[^\n\r\x85\u2028\u2029]*?\*\*\*")  # Java "." 
TA = re.compile(r"(.*)\s+by\s+(.*)", re.ASCII)
marker_text_st = st.lists(st.sampled_from(
    ["***", "*", "x", " ", "\n", "\r", "\x85", "\u2028", "\t", "\x01", "by", " by ", "Ab",
     "ye"]),
    max_size=30).map("".join)


def py_strip_header(t):
    m = JAVA_MARKER.search(t)
    if not m:
        return t
    rest = t[m.end():]
    i, j = 0, len(rest)
    while i < j and ord(rest[i]) <= 0x20:
        i += 1
    while j > i and ord(rest[j - 1]) <= 0x20:
        j -= 1
    return rest[i:j]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(marker_text_st, min_size=1, max_size=30))
def test_header_strip_and_title_split_match_java_rules(spark, texts):
    from quire.functions.html import split_author, split_title
    from quire.functions.text import strip_header
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    got = df.select("i", strip_header("t").alias("s")).orderBy("i").collect()
    assert [r.s for r in got] == [py_strip_header(t) for t in texts]
    # headings are whitespace-normalized single lines
    heads = [" ".join(t.replace("\x85", " ").replace("\u2028", " ").split()) for t in texts]
    hdf = spark.createDataFrame([(i, h) for i, h in enumerate(heads)], "i INT, h STRING")
    got = hdf.select("i", split_title("h").alias("a"), split_author("h").alias("b")) \
        .orderBy("i").collect()
    for r, h in zip(got, heads):
        m = TA.search(h)
        assert (r.a, r.b) == ((m.group(1).strip(), m.group(2).strip()) if m else
                              ("Unknown", "Unknown")), repr(h)


from html.parser import HTMLParser  # noqa: E402

BLOCKS = {"br", "p", "div", "li", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "table",
          "tr", "td", "th", "article", "section", "nav", "header", "footer", "blockquote",
          "pre"}


class _Page(HTMLParser):
    """Reference-style extraction with a real HTML parser (jsoup-like text rules)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.h1, self.cells, self.anchors = [], None, [], []
        self.cur_h1, self.cur_td, self.cur_a = None, None, None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in BLOCKS:
            for buf in (self.cur_h1, self.cur_td, self.cur_a):
                if buf is not None:
                    buf.append(" ")
        if tag == "h1" and self.h1 is None and self.cur_h1 is None:
            self.cur_h1 = []
        elif tag == "td":
            self.cur_td, self.td_attrs = [], a
        elif tag == "a":
            self.cur_a, self.a_href = [], a.get("href", "")

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            for buf in (self.cur_h1, self.cur_td, self.cur_a):
                if buf is not None:
                    buf.append(" ")
        norm = lambda b: " ".join("".join(b).replace("\xa0", " ").split(" ")).split()  # noqa
        if tag == "h1" and self.cur_h1 is not None:
            self.h1, self.cur_h1 = " ".join(norm(self.cur_h1)), None
        elif tag == "td" and self.cur_td is not None:
            self.cells.append((" ".join(norm(self.cur_td)), self.td_attrs.get("itemprop")))
            self.cur_td = None
        elif tag == "a" and self.cur_a is not None:
            self.anchors.append((" ".join(norm(self.cur_a)), self.a_href))
            self.cur_a = None

    def handle_data(self, data):
        for buf in (self.cur_h1, self.cur_td, self.cur_a):
            if buf is not None:
                buf.append(data)


word_st = st.sampled_from(["Moby", "Dick", "by", "Sea", "&amp;", "&lt;x&gt;", "Tales", "A"])
inline_st = st.lists(st.one_of(word_st, word_st.map(lambda w: f"<i>{w}</i>"),
                               word_st.map(lambda w: f"<b> {w} </b>")), min_size=1, max_size=6)
page_st = st.tuples(
    inline_st, st.lists(st.sampled_from(["English", "Dutch", "Klingon", "  French ", "english"]),
                        max_size=3),
    st.lists(st.sampled_from(["Jan 2, 1990", "Unknown x", " May 1, 2001 "]), max_size=2),
    st.lists(st.tuples(st.sampled_from(["Plain Text UTF-8", "EPUB", "plain text utf-8 (zip)"]),
                       st.sampled_from(['"/ebooks/1.txt"', "'/files/2.txt?a=1&amp;b=2'",
                                        '"http://x/3.txt"'])), max_size=3))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(page_st, min_size=1, max_size=10))
def test_html_extraction_matches_a_parser_on_well_formed_pages(spark, pages):
    from quire.functions.html import download_link, heading, language_cell, release_date
    htmls = []
    for h1, langs, dates, anchors in pages:
        cells = "".join(f"<td>{l}</td>" for l in langs) + \
            "".join(f'<td itemprop="datePublished">{d}</td>' for d in dates)
        links = "".join(f"<a href={href}>{text}</a>" for text, href in anchors)
        htmls.append(f"<html><body><h1>{' '.join(h1)}</h1><table><tr>{cells}</tr></table>"
                     f"{links}</body></html>")
    df = spark.createDataFrame([(i, h) for i, h in enumerate(htmls)], "i INT, html STRING")
    got = df.select("i", heading("html").alias("h"), release_date("html").alias("d"),
                    language_cell("html").alias("l"), download_link("html").alias("a")) \
        .orderBy("i").collect()
    for r, html in zip(got, htmls):
        p = _Page()
        p.feed(html)
        dates = " ".join(t for t, prop in p.cells if prop == "datePublished").strip()
        langs = [t for t, _ in p.cells if t in ("English", "Spanish", "French", "German",
                                                "Italian", "Dutch", "Chinese", "Russian",
                                                "Japanese")]
        dl = [href for text, href in p.anchors if "plain text utf-8" in text.lower()]
        assert r.h == p.h1
        assert r.d == (dates or "Unknown")
        assert r.l == (langs[0] if langs else "Unknown")
        assert r.a == (dl[0] if dl else None)


class _Listing(HTMLParser):
    """Anchors with href^='/ebooks/' inside li elements whose class list has booklink."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.in_item, self.links = False, []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "li":
            self.in_item = "booklink" in (a.get("class") or "").split()
        elif tag == "a" and self.in_item and (a.get("href") or "").startswith("/ebooks/"):
            self.links.append(a["href"])

    def handle_endtag(self, tag):
        if tag == "li":
            self.in_item = False


item_st = st.tuples(st.sampled_from(["booklink", "x booklink", "booklinks", "other", "booklink y"]),
                    st.sampled_from(["/ebooks/1", "/ebooks/22?a=1&amp;b=2", "/other/3", "/ebooks/"]),
                    st.sampled_from(['"', "'"]))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(item_st, max_size=6), min_size=1, max_size=8))
def test_book_links_match_a_parser(spark, pages):
    from quire.functions.html import book_links
    htmls = ["<html><body><a href=\"/ebooks/0\">out</a><ul>" + "".join(
        f'<li class={q}{cls}{q}><a href={q}{href}{q}>t</a></li>' for cls, href, q in items)
        + "</ul></body></html>" for items in pages]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(htmls)], "i INT, html STRING")
    got = [r.l for r in df.select("i", book_links("html").alias("l")).orderBy("i").collect()]
    for links, html in zip(got, htmls):
        p = _Listing()
        p.feed(html)
        assert links == p.links


class _Body(HTMLParser):
    """Whole text of body: data of every text node, br as a newline, no script/style."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.in_body, self.skip, self.out = False, 0, []

    def handle_starttag(self, tag, attrs):
        if tag == "body":
            self.in_body = True
        elif tag in ("script", "style"):
            self.skip += 1
        elif tag == "br" and self.in_body:
            self.out.append("\n")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip -= 1
        elif tag == "body":
            self.in_body = False

    def handle_data(self, data):
        if self.in_body and not self.skip:
            self.out.append(data)


chunk_st = st.sampled_from([
    "<p>one  two</p>", "<br>", "<br/>", "<b>x</b>y", "<script>var a = '<b>';</script>",
    "<style>p{a:b}</style>", "<!-- note -->", "a &amp; b", "&lt;tag&gt;", "\n  text\t",
    "&quot;q&quot;", "<div>d</div>", "&copy; &middot;"])


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(chunk_st, max_size=8).map("".join), min_size=1, max_size=8))
def test_body_text_matches_a_parser(spark, bodies):
    from quire.functions.html import body_text
    htmls = [f"<html><head><title>t</title><script>x()</script></head><body>{b}</body></html>"
             for b in bodies]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(htmls)], "i INT, html STRING")
    got = [r.t for r in df.select("i", body_text("html").alias("t")).orderBy("i").collect()]
    for text, html in zip(got, htmls):
        p = _Body()
        p.feed(html)
        assert text == "".join(p.out), repr(html)
