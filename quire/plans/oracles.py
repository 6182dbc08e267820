"""DuckDB SQL stating the same result as each registered query (the correctness oracle).

Tables ``documents``, ``benchmark`` and ``pages`` are views over the same Parquet files.
RE2 (DuckDB) and Java regex (Spark) differ on a few classes; the SQL spells those out:
Java ``\\s`` includes VT, Java ``.`` excludes \\r, U+0085, U+2028, U+2029 as well as \\n.
"""

from __future__ import annotations

from quire.constants import (
    BASE_URL, FRAGMENT_STUB, LANGUAGES, METADATA_PAIR, MONTHS, MONTHS_SHORT, STOPWORDS,
    TOKEN_BREAK_CLASS,
)
from quire.plans.fixtures import (
    BOOKS_PER_LISTING, CRITERIA_PROFILES, DATE_MULT, DATE_ORIGIN, DATE_SPAN, LANG_NAMES,
    NO_DOWNLOAD_EVERY, FIRST_SENTENCE, FIRST_TWO_WORDS, UNKNOWN_DATE_EVERY,
)

# the oracles' own HTML patterns (RE2), stated apart from the library's; they cover the pages
# of the test tables, and tests/test_html.py has the expected texts of other pages
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
            ("&nbsp;", " "), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&"))
BLOCK = (r"(?i)</?(br|p|div|li|ul|ol|h[1-6]|table|tr|td|th|article|section|nav|"
               r"header|footer|blockquote|pre)\b[^>]*>")
H1 = r"(?is)<h1\b[^>]*>(.*?)</h1>"
DATE_CELL = r"""(?is)<td\b[^>]*itemprop=["']?datePublished["']?[^>]*>(.*?)</td>"""
CELL = r"(?is)<td\b[^>]*>(.*?)</td>"
ANCHOR = r"(?is)<a\b([^>]*)>(.*?)</a>"
HREF = r"""(?is)\bhref\s*=\s*["']([^"']*)["']"""
LI = (r"""(?is)<li\b[^>]*class\s*=\s*["'](?:[^"']*\s)?booklink(?:\s[^"']*)?["'][^>]*>"""
                 r"""(.*?)</li>""")
LI_HREF = r"""(?is)<a\b[^>]*\bhref\s*=\s*["'](/ebooks/[^"']*)["']"""


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


STOP = "(" + ", ".join(_q(w) for w in STOPWORDS) + ")"
JWS = r"[\t\n\x0B\f\r ]"                         # Java \s
JDOT = r"[^\n\r\x{85}\x{2028}\x{2029}]"          # Java . (no DOTALL)
HEADER = r"\*\*\*" + JDOT + r"*?\*\*\*"


def tokens_of(text: str) -> str:
    return (f"list_filter(regexp_split_to_array(regexp_replace(lower({text}), "
            f"{_q(TOKEN_BREAK_CLASS)}, ' ', 'g'), '{JWS}+'), lambda x: x <> '')")


def distinct_in_order(lst: str) -> str:
    return f"list_filter({lst}, lambda x, i: list_position({lst}, x) = i)"


def strip_header(text: str) -> str:
    rest = f"regexp_replace({text}, '(?s)^.*?{HEADER}', '')"
    trimmed = f"regexp_replace({rest}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"
    return f"CASE WHEN regexp_matches({text}, '{HEADER}') THEN {trimmed} ELSE {text} END"


# ---- shared CTEs ---------------------------------------------------------------------

TOK = f"tok AS (SELECT doc_id AS book_id, {tokens_of('text')} AS t FROM documents)"
TP = ("tp AS (SELECT book_id, CAST(i AS INTEGER) AS pos, t[i + 1] AS word "
      "FROM tok, range(len(t)) r(i))")
IDX = (f"idx AS (SELECT word, book_id, list_sort(list_distinct(list(pos))) AS p "
       f"FROM tp WHERE word NOT IN {STOP} GROUP BY word, book_id)")
BASE = f"WITH {TOK}, {TP}, {IDX}"

TITLE = f"regexp_extract(text, {_q(FIRST_SENTENCE)})"
LANG = ("CASE lang " + " ".join(f"WHEN {_q(c)} THEN {_q(n)}" for c, n in LANG_NAMES)
        + " ELSE 'Unknown' END")
RDATE = (f"CASE WHEN doc_id % {UNKNOWN_DATE_EVERY} = 0 THEN 'Unknown' ELSE "
         f"strftime(DATE '{DATE_ORIGIN}' + CAST((doc_id * {DATE_MULT}) % {DATE_SPAN} AS INTEGER), "
         f"'%b %-d, %Y') END")


def catalog_fields(text: str = "text", where: str = "") -> str:
    return (f"SELECT doc_id AS book_id, regexp_extract({text}, {_q(FIRST_SENTENCE)}) AS title, "
            f"'Author ' || source AS author, {RDATE} AS release_date, {LANG} AS language "
            f"FROM documents {where}")


def line_of(alias: str = "") -> str:
    a = alias + "." if alias else ""
    return (f"'ID: ' || {a}book_id || ', Title: ' || {a}title || ', Author: ' || {a}author || "
            f"', Release Date: ' || {a}release_date || ', Language: ' || {a}language")


LINES = (f"lines AS (SELECT 1 AS delivery, book_id AS seq, {line_of()} AS line "
         f"FROM ({catalog_fields()}))")
LINES2 = (f"lines AS (SELECT 1 AS delivery, book_id AS seq, {line_of()} AS line "
          f"FROM ({catalog_fields()}) UNION ALL "
          f"SELECT 2, book_id, {line_of()} FROM ({catalog_fields(strip_header('text'), chr(10) + 'WHERE regexp_matches(text, ' + _q(HEADER) + ')')}))")


def field(kv: str, key: str) -> str:
    return f"list_filter({kv}, lambda p: p[1] = {_q(key)})[-1][2]"


PARSED = (f"kvl AS (SELECT delivery, seq, list_zip(regexp_extract_all(line, {_q(METADATA_PAIR)}, 1), "
          f"regexp_extract_all(line, {_q(METADATA_PAIR)}, 2)) AS kv FROM lines), "
          f"parsed AS (SELECT delivery, seq, "
          f"CAST(CASE WHEN {field('kv', 'ID')} IS NULL THEN -1 "
          f"WHEN regexp_full_match({field('kv', 'ID')}, '[+-]?[0-9]+') "
          f"THEN TRY_CAST({field('kv', 'ID')} AS INTEGER) END AS BIGINT) AS book_id, "
          f"{field('kv', 'Title')} AS title, {field('kv', 'Author')} AS author, "
          f"{field('kv', 'Date')} AS date, {field('kv', 'Language')} AS language, "
          f"array_to_string(list_sort(list_distinct(list_filter(list_transform(kv, lambda p: p[1]), "
          f"lambda k: k <> 'ID'))), ',') AS keys FROM kvl)")
CATALOG = ("cat AS (SELECT book_id, title, author, date, language FROM parsed "
           "WHERE book_id >= 0 QUALIFY row_number() OVER (PARTITION BY book_id "
           "ORDER BY delivery DESC, seq DESC) = 1)")


def year_of(d: str) -> str:
    pat = r"'^[ \t]*([A-Za-z]+)\s+[ \t]*(\d{1,2}),\s+[ \t]*(\d{1,4})'"
    full = "[" + ", ".join(_q(m.lower()) for m in MONTHS) + "]"
    short = "[" + ", ".join(_q(m.lower()) for m in MONTHS_SHORT) + "]"
    m = f"lower(regexp_extract({d}, {pat}, 1))"
    month = f"greatest(coalesce(list_position({full}, {m}), 0), coalesce(list_position({short}, {m}), 0))"
    day = f"TRY_CAST(regexp_extract({d}, {pat}, 2) AS INTEGER)"
    yr = f"TRY_CAST(regexp_extract({d}, {pat}, 3) AS INTEGER)"
    return (f"CASE WHEN regexp_matches({d}, {pat}) AND {month} > 0 AND {yr} >= 1 THEN "
            f"CAST(year(make_date({yr}, {month}, 1) + ({day} - 1)) AS INTEGER) END")


PASSAGE_REQ = (f"req AS (SELECT CAST(item_id AS BIGINT) AS query_id, "
               f"{distinct_in_order('list_filter(' + tokens_of('text') + ', lambda w: w NOT IN ' + STOP + ')')} AS words "
               f"FROM benchmark)")
TITLE_REQ = (f"req AS (SELECT doc_id AS query_id, list_distinct(list_filter({tokens_of(TITLE)}, "
             f"lambda w: w NOT IN {STOP})) AS words FROM documents)")
RW = "rw AS (SELECT query_id, unnest(words) AS word, len(words) AS n_words FROM req)"
CAND = ("cand AS (SELECT rw.query_id, rw.n_words, idx.word, idx.book_id, idx.p "
        "FROM idx JOIN rw ON idx.word = rw.word)")
MATCH = ("m AS (SELECT query_id, book_id FROM cand GROUP BY query_id, book_id, n_words "
         "HAVING count(*) = n_words)")
MCAND = "mc AS (SELECT cand.* FROM cand SEMI JOIN m ON cand.query_id = m.query_id AND cand.book_id = m.book_id)"
PASSAGE_SEARCH = f"{BASE}, {PASSAGE_REQ}, {RW}, {CAND}, {MATCH}, {MCAND}"
POS_TEXT = "string_agg(word || ':' || array_to_string(p, ' '), ';' ORDER BY word)"



def decode(x: str) -> str:
    for e, c in ENTITIES:
        x = f"replace({x}, {_q(e)}, {_q(c)})"
    return x


def html_text(x: str) -> str:
    t = f"regexp_replace(regexp_replace({x}, {_q(BLOCK)}, ' ', 'g'), '<[^>]*>', '', 'g')"
    return f"trim(regexp_replace({decode(t)}, '[ \\t\\n\\f\\r\u00a0]+', ' ', 'g'))"


HEADING = f"CASE WHEN regexp_matches(html, '(?is)<h1\\b') THEN {html_text(f'regexp_extract(html, {_q(H1)}, 1)')} END"
TA = r"(.*)\s+by\s+(.*)"


def title_part(h: str, g: int) -> str:
    return f"CASE WHEN regexp_matches({h}, {_q(TA)}) THEN trim(regexp_extract({h}, {_q(TA)}, {g})) ELSE 'Unknown' END"



RELEASE = (f"CASE WHEN trim(array_to_string(list_transform(regexp_extract_all(html, {_q(DATE_CELL)}, 1), "
           f"lambda c: {html_text('c')}), ' ')) = '' THEN 'Unknown' ELSE "
           f"trim(array_to_string(list_transform(regexp_extract_all(html, {_q(DATE_CELL)}, 1), "
           f"lambda c: {html_text('c')}), ' ')) END")
LANGS = "[" + ", ".join(_q(x) for x in LANGUAGES) + "]"
LANGUAGE = (f"coalesce(list_filter(list_transform(regexp_extract_all(html, {_q(CELL)}, 1), "
            f"lambda c: {html_text('c')}), lambda t: list_contains({LANGS}, t))[1], 'Unknown')")
DOWNLOAD = decode(f"regexp_extract(list_filter(regexp_extract_all(html, {_q(ANCHOR)}, 0), lambda a: "
                  f"contains(lower({html_text(f'regexp_extract(a, {_q(ANCHOR)}, 2)')}), 'plain text utf-8'))[1], "
                  f"{_q(HREF)}, 1)")

BOOK_PAGES = (
    "bp AS (SELECT '/ebooks/' || book_id AS href, '<html><body><h1>' || replace(title, '<', ' ') "
    "|| ' by ' || author || '</h1><table><tr><td>' || language || '</td>' || "
    "CASE WHEN release_date = 'Unknown' THEN '' ELSE '<td itemprop=\"datePublished\">' || release_date || '</td>' END "
    f"|| '</tr></table>' || CASE WHEN book_id % {NO_DOWNLOAD_EVERY} = 0 THEN '' ELSE '<a href=\"/ebooks/' || book_id || "
    "'.txt.utf-8\">Plain Text UTF-8</a>' END || '</body></html>' AS html FROM (" + catalog_fields() + "))")


def listing(where: str = "") -> str:
    return (f"SELECT CAST(floor(doc_id / {BOOKS_PER_LISTING}) * {BOOKS_PER_LISTING} AS INTEGER) AS start_index, "
            "'<html><body><a href=\"/ebooks/search\">all</a><ul>' || string_agg('<li class=\"booklink\">"
            "<a href=\"/ebooks/' || doc_id || '\">x</a></li>', '' ORDER BY doc_id) || '</ul></body></html>' "
            f"AS html FROM documents {where} GROUP BY 1")


LINKS = (f"links AS (SELECT start_index, list_transform(flatten(list_transform(regexp_extract_all(html, {_q(LI)}, 1), "
         f"lambda i: regexp_extract_all(i, {_q(LI_HREF)}, 1))), lambda h: {decode('h')}) AS l FROM lp)")
LINK_ROWS = ("lr AS (SELECT start_index, CAST(i AS INTEGER) AS link_no, l[i + 1] AS href "
             "FROM links, range(len(l)) r(i))")
FRONTIER = ("fr AS (SELECT CAST(g AS INTEGER) AS page, false AS claimed FROM "
            "(SELECT max(start_index) AS mx FROM lp), generate_series(0, mx, 25) s(g))")


def criteria_sql(title=None, author=None, year_from=None, year_to=None, language=None) -> str:
    parts = []
    if title is not None:
        parts.append(f"contains(lower(c.title), lower({_q(title)}))")
    if author is not None:
        parts.append(f"contains(lower(c.author), lower({_q(author)}))")
    if year_from is not None:
        parts.append(f"{year_of('c.date')} >= {int(year_from)}")
    if year_to is not None:
        parts.append(f"{year_of('c.date')} <= {int(year_to)}")
    if language is not None:
        parts.append(f"contains(lower(c.language), lower({_q(language)}))")
    return " AND ".join(parts) if parts else "true"


def criteria_search(**criteria) -> str:
    return (f"{BASE}, {TITLE_REQ}, {RW}, {CAND}, {MATCH}, {LINES}, {PARSED}, {CATALOG} "
            f"SELECT m.query_id, m.book_id FROM m JOIN cat c ON m.book_id = c.book_id "
            f"WHERE {criteria_sql(**criteria)}")


def search_batch_sql() -> str:
    cases = []
    for p, values in enumerate(CRITERIA_PROFILES):
        crit = dict(zip(("title", "author", "year_from", "year_to", "language"), values))
        if all(v is None for v in values):
            cases.append(f"(m.query_id % 5 = {p})")
        else:
            cases.append(f"(m.query_id % 5 = {p} AND c.book_id IS NOT NULL AND "
                         f"coalesce({criteria_sql(**crit)}, false))")
    return (f"{BASE}, {TITLE_REQ}, {RW}, {CAND}, {MATCH}, {MCAND}, {LINES}, {PARSED}, {CATALOG}, "
            f"ok AS (SELECT m.query_id, m.book_id FROM m LEFT JOIN cat c ON m.book_id = c.book_id "
            f"WHERE {' OR '.join(cases)}) "
            f"SELECT mc.query_id, mc.book_id, {POS_TEXT} AS positions FROM mc SEMI JOIN ok "
            f"ON mc.query_id = ok.query_id AND mc.book_id = ok.book_id GROUP BY 1, 2")


# a page cut off before </body>, in a script or in a tag: its text ends where the page ends
OPENED = r"regexp_extract(html, '(?is)<body\b[^>]*>(.*)$', 1)"
BODY = (f"CASE WHEN regexp_matches({OPENED}, '(?i)</body>') "
        f"THEN regexp_extract({OPENED}, '(?is)^(.*)</body>', 1) ELSE {OPENED} END")
HIDDEN = r"'(?is)<script\b.*?(</script>|$)|<style\b.*?(</style>|$)|<!--.*?(-->|$)'"
TAGS_REMOVED = "regexp_replace(x, '<[^>]*>|<[A-Za-z/!][^>]*$', '', 'g')"
FLAT = "SELECT word, book_id, array_to_string(p, ',') AS positions FROM idx"
TP_STRIPPED = (f"tok2 AS (SELECT doc_id AS book_id, {tokens_of(strip_header('text'))} AS t FROM documents), "
               f"tp2 AS (SELECT book_id, CAST(i AS INTEGER) AS pos, t[i + 1] AS word FROM tok2, range(len(t)) r(i))")

ORACLES: dict[str, str] = {
    "scan_books": "SELECT CAST(doc_id AS VARCHAR) AS doc_key, doc_id AS book_id, text FROM documents",
    "stopwords": f"WITH {TOK}, {TP} SELECT word, count(*) AS n_removed FROM tp WHERE word IN {STOP} GROUP BY word",
    "book_id_from_path": (
        "WITH p AS (SELECT 'C:\\corpus\\' || source || '\\00' || doc_id || '.txt' AS path FROM documents), "
        "k AS (SELECT path, regexp_replace(string_split(replace(path, '\\', '/'), '/')[-1], '[^0-9]', '', 'g') AS doc_key FROM p) "
        "SELECT path, doc_key, CAST(TRY_CAST(doc_key AS INTEGER) AS BIGINT) AS book_id FROM k"),
    "tokenize": (f"WITH {TOK} SELECT book_id, CAST(len(t) AS INTEGER) AS n_tokens, "
                 f"array_to_string(t, ' ') AS tokens FROM tok"),
    "token_positions": f"WITH {TOK}, {TP} SELECT book_id, pos, word FROM tp",
    "remove_stopwords": f"WITH {TOK}, {TP} SELECT book_id, pos, word FROM tp WHERE word NOT IN {STOP}",
    "custom_tokenizer": ("WITH tok AS (SELECT doc_id AS book_id, regexp_extract_all(lower(text), '\\p{L}+') AS t FROM documents), "
                         f"{TP} SELECT book_id, pos, word FROM tp WHERE word NOT IN {STOP}"),
    "build_postings": (f"{BASE} SELECT word, book_id, array_to_string(p, ',') AS positions, "
                       f"CAST(len(p) AS INTEGER) AS n_positions FROM idx"),
    "merge_postings": (f"WITH {TOK}, {TP}, {TP_STRIPPED}, u AS (SELECT * FROM tp UNION ALL SELECT * FROM tp2) "
                       f"SELECT word, book_id, array_to_string(list_sort(list_distinct(list(pos))), ',') AS positions "
                       f"FROM u WHERE word NOT IN {STOP} GROUP BY word, book_id"),
    "word_books": f"{BASE} SELECT word, book_id FROM idx",
    "word_to_books": (f"{BASE} SELECT word, count(*) AS n_books, min(book_id) AS first_book, "
                      f"max(book_id) AS last_book FROM idx GROUP BY word"),
    "postings_keyed": f"{BASE} SELECT word || '|' || book_id AS key, array_to_string(p, ',') AS positions FROM idx",
    "index_sizes": (f"{BASE} SELECT count(*) AS word_book_entries, "
                    f"CAST(coalesce(sum(len(p)), 0) AS BIGINT) AS position_entries FROM idx"),
    "incremental_index": f"{BASE} {FLAT}",
    "side_by_side_index": f"{BASE} {FLAT}",
    "tiered_index": f"{BASE} {FLAT}",
    "stream_index": f"{BASE} {FLAT}",
    "indexed_books": "SELECT CAST(doc_id AS VARCHAR) AS doc_key FROM documents",
    "nbooks": "SELECT count(DISTINCT doc_id) AS nbooks FROM documents",
    "is_indexed": ("SELECT CAST(doc_id AS VARCHAR) AS doc_key, doc_id AS book_id, "
                   "coalesce(lang = 'en', false) AS is_indexed FROM documents"),
    "store_books": (f"SELECT doc_id AS book_id, CAST(doc_id AS VARCHAR) AS doc_key, "
                    f"CASE WHEN regexp_matches(text, '{HEADER}') THEN {strip_header('text')} ELSE text END AS text "
                    f"FROM documents"),
    "catalog_lines": f"WITH {LINES} SELECT line FROM lines",
    "parse_catalog": f"WITH {LINES}, {PARSED} SELECT book_id, title, author, date, language, keys FROM parsed",
    "load_catalog": f"WITH {LINES}, {PARSED}, {CATALOG} SELECT * FROM cat",
    "catalog_last_wins": f"WITH {LINES2}, {PARSED}, {CATALOG} SELECT * FROM cat",
    "catalog_log": f"WITH {LINES2}, {PARSED}, {CATALOG} SELECT * FROM cat",
    "release_year": f"WITH {LINES}, {PARSED}, {CATALOG} SELECT book_id, date, CAST({year_of('date')} AS VARCHAR) AS year FROM cat",
    "books_by_word": (f"{BASE}, {PASSAGE_REQ}, w AS (SELECT DISTINCT unnest(words) AS word FROM req) "
                      f"SELECT idx.word, idx.book_id FROM idx JOIN w ON idx.word = w.word"),
    "positions_in_book": (f"{BASE}, {TITLE_REQ}, k AS (SELECT DISTINCT unnest(words) AS word, query_id AS book_id FROM req) "
                          f"SELECT idx.word, idx.book_id, array_to_string(idx.p, ',') AS positions "
                          f"FROM idx JOIN k ON idx.word = k.word AND idx.book_id = k.book_id"),
    "parse_query": (
        f"WITH r AS (SELECT item_id AS query_id, regexp_replace(text, '{JWS}', '+', 'g') AS q FROM benchmark), "
        "s AS (SELECT query_id, q, regexp_replace(q, '\\++$', '') AS st FROM r), "
        "w AS (SELECT query_id, CASE WHEN q = '' THEN [''] WHEN st = '' THEN []::VARCHAR[] "
        "ELSE string_split(st, '+') END AS words FROM s) "
        "SELECT query_id, CAST(len(words) AS INTEGER) AS n_words, array_to_string(words, '|') AS words FROM w"),
    "search_any_candidates": (f"{BASE}, {PASSAGE_REQ}, {RW}, {CAND} SELECT query_id, word, book_id, "
                              f"array_to_string(p, ',') AS positions FROM cand"),
    "search_all_words": (f"{PASSAGE_SEARCH} SELECT query_id, book_id, word, "
                         f"array_to_string(p, ',') AS positions FROM mc"),
    "search_intersect": (
        f"{BASE}, {PASSAGE_REQ}, pr AS (SELECT query_id, CAST(i AS INTEGER) AS pair, words[i + 1] AS w1, "
        f"words[i + 2] AS w2 FROM req, range(greatest(len(words) - 1, 0)) r(i)), "
        f"a AS (SELECT pr.query_id, pr.pair, idx.book_id FROM idx JOIN pr ON idx.word = pr.w1), "
        f"b AS (SELECT pr.query_id, pr.pair, idx.book_id FROM idx JOIN pr ON idx.word = pr.w2) "
        f"SELECT query_id, pair, book_id FROM a INTERSECT SELECT query_id, pair, book_id FROM b"),
    "search_result_map": f"{PASSAGE_SEARCH} SELECT query_id, book_id, {POS_TEXT} AS positions FROM mc GROUP BY 1, 2",
    "flatten_positions": (f"{PASSAGE_SEARCH} SELECT query_id, book_id, array_to_string(list_sort(flatten(list(p))), ',') "
                          f"AS positions FROM mc GROUP BY 1, 2"),
    "search_title": criteria_search(title="e"),
    "search_author": criteria_search(author="SRC1"),
    "search_language": criteria_search(language="english"),
    "search_from": criteria_search(year_from="2000"),
    "search_to": criteria_search(year_to="2005"),
    "search_filtered": criteria_search(author="author src1", year_from="1998", year_to="2012", language="E"),
    "search_batch": search_batch_sql(),
    "search_json": (f"{PASSAGE_SEARCH} SELECT query_id, book_id, to_json({{'bookId': book_id, "
                    f"'positions': map_from_entries(list((word, p) ORDER BY word))}}) AS json FROM mc GROUP BY 1, 2"),
    "fragment_stub": (f"{PASSAGE_SEARCH} SELECT query_id, book_id, word, pos, "
                      f"printf({_q(FRAGMENT_STUB)}, CAST(pos AS VARCHAR), CAST(book_id AS VARCHAR)) AS fragment "
                      f"FROM mc, unnest(p) AS u(pos)"),
    "text_fragment": (f"{PASSAGE_SEARCH}, h AS (SELECT query_id, book_id, word, pos FROM mc, unnest(p) AS u(pos)) "
                      f"SELECT h.query_id, h.book_id, h.word, h.pos, array_to_string(tok.t[greatest(h.pos - 5, 0) + 1 : h.pos + 5 + 1], ' ') "
                      f"AS fragment FROM h JOIN tok ON h.book_id = tok.book_id"),
    "strip_header": f"SELECT doc_id AS book_id, {strip_header('text')} AS text FROM documents",
    "index_pages": (
        "WITH b AS (SELECT page_id, " + BODY + " AS x FROM pages), "
        "c AS (SELECT page_id, regexp_replace(regexp_replace(x, " + HIDDEN + ", '', 'g'), "
        "'(?i)<br\\b[^>]*>', chr(10), 'g') AS x FROM b), "
        + f"d AS (SELECT page_id, {decode(TAGS_REMOVED)} AS x FROM c), "
        + f"tok AS (SELECT page_id AS book_id, {tokens_of(strip_header('x'))} AS t FROM d), {TP}, {IDX} {FLAT}"),
    "title_author": (f"WITH {BOOK_PAGES}, hh AS (SELECT href, {HEADING} AS h FROM bp) "
                     f"SELECT href, {title_part('h', 1)} AS title, {title_part('h', 2)} AS author FROM hh"),
    "page_heading": f"SELECT page_id, {HEADING} AS heading FROM pages",
    "page_text": (
        "WITH b AS (SELECT page_id, " + BODY + " AS x FROM pages), "
        "c AS (SELECT page_id, regexp_replace(regexp_replace(x, " + HIDDEN + ", '', 'g'), "
        "'(?i)<br\\b[^>]*>', chr(10), 'g') AS x FROM b) "
        f"SELECT page_id, {decode(TAGS_REMOVED)} AS text FROM c"),
    "extract_links": f"WITH lp AS ({listing()}), {LINKS}, {LINK_ROWS} SELECT start_index, link_no, href FROM lr",
    "links_per_page": f"WITH lp AS ({listing()}), {LINKS} SELECT start_index, CAST(len(l) AS INTEGER) AS n_links FROM links",
    "extract_book_record": (
        f"WITH {BOOK_PAGES}, r AS (SELECT href, {HEADING} AS h, {RELEASE} AS release_date, {LANGUAGE} AS language, "
        f"{DOWNLOAD} AS download, nullif(string_split(href, '/')[3], '') AS book_id FROM bp) "
        f"SELECT href, book_id, {title_part('h', 1)} AS title, {title_part('h', 2)} AS author, release_date, language, "
        f"CASE WHEN starts_with(download, 'http') THEN download ELSE {_q(BASE_URL)} || download END AS download_url "
        f"FROM r WHERE h IS NOT NULL AND download IS NOT NULL AND book_id IS NOT NULL"),
    "crawl_to_catalog": (
        f"WITH {BOOK_PAGES}, r AS (SELECT href, {HEADING} AS h, {RELEASE} AS release_date, {LANGUAGE} AS language, "
        f"{DOWNLOAD} AS download, string_split(href, '/')[3] AS book_id FROM bp), "
        f"lines AS (SELECT 1 AS delivery, book_id AS seq, {line_of()} AS line FROM (SELECT book_id, "
        f"{title_part('h', 1)} AS title, {title_part('h', 2)} AS author, release_date, language "
        f"FROM r WHERE h IS NOT NULL AND download IS NOT NULL)), {PARSED}, {CATALOG} SELECT * FROM cat"),
    "crawl_to_index": (
        f"WITH {BOOK_PAGES}, r AS (SELECT {HEADING} AS h, {DOWNLOAD} AS download, string_split(href, '/')[3] AS book_id FROM bp), "
        f"d AS (SELECT doc_id AS book_id, {strip_header('text')} AS x FROM documents WHERE CAST(doc_id AS VARCHAR) IN "
        f"(SELECT book_id FROM r WHERE h IS NOT NULL AND download IS NOT NULL)), "
        f"tok AS (SELECT book_id, {tokens_of('x')} AS t FROM d), {TP}, {IDX} {FLAT}"),
    "release_date": f"WITH {BOOK_PAGES} SELECT href, {RELEASE} AS release_date FROM bp",
    "detect_language": f"WITH {BOOK_PAGES} SELECT href, {LANGUAGE} AS language FROM bp",
    "download_link": f"WITH {BOOK_PAGES} SELECT href, {DOWNLOAD} AS download FROM bp",
    "absolute_url": (f"WITH {BOOK_PAGES}, d AS (SELECT href, {DOWNLOAD} AS download FROM bp) SELECT href, "
                     f"CASE WHEN starts_with(download, 'http') THEN download ELSE {_q(BASE_URL)} || download END AS url "
                     f"FROM d WHERE download IS NOT NULL"),
    "link_book_id": (f"WITH lp AS ({listing()}), {LINKS}, {LINK_ROWS} SELECT href, "
                     f"nullif(string_split(href, '/')[3], '') AS book_id FROM lr"),
    "crawl_frontier": f"WITH lp AS ({listing()}), {FRONTIER} SELECT page, claimed FROM fr",
    "pending_pages": (f"WITH lp AS ({listing()}), {FRONTIER}, done AS ({listing('WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)')}) "
                      f"SELECT page, claimed FROM fr WHERE NOT claimed AND page NOT IN (SELECT start_index FROM done)"),
    "claimed_pages": (
        f"WITH lp AS ({listing()}), {FRONTIER}, done AS ({listing('WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)')}), "
        f"r AS (SELECT page, row_number() OVER (ORDER BY page) AS n, (SELECT count(*) FROM fr) // 3 AS k FROM fr) "
        f"SELECT page, (n <= k AND page IN (SELECT start_index FROM done)) OR (n > k AND n <= 2 * k) AS claimed, "
        f"CASE WHEN n <= k THEN 'a' WHEN n <= 2 * k THEN 'b' END AS taker FROM r"),
    "criteria_books": (
        f"WITH {LINES}, {PARSED}, {CATALOG}, "
        f"q AS (SELECT 'title' AS field, regexp_extract(text, {_q(FIRST_TWO_WORDS)}) AS criterion FROM benchmark "
        f"UNION SELECT 'author', source FROM documents) "
        f"SELECT DISTINCT q.field, q.criterion, c.book_id FROM q JOIN cat c ON q.criterion IS NOT NULL AND "
        f"contains(lower(CASE q.field WHEN 'title' THEN c.title ELSE c.author END), lower(q.criterion))"),
}
