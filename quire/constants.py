"""Fixed values that must equal the reference behaviour for identical results.

Everything in this module is a constant, stated once, in its natural order.
"""

# --- fixed values: tokenizer character class -------------------------------------------
# Every character of this class becomes ONE space before the whitespace split.  ASCII
# digits are in the class; the ASCII apostrophe is NOT (so "don't" stays one token), while
# the curly quotes are.  Valid in both Java regex (Spark) and RE2 (DuckDB oracles).
TOKEN_BREAK_CLASS = "[\\[\\]\\\\,.;:º\\dª&`’´\\-_()¡\"!?¿{}=+<>|^“‘/$™%—•*”]"
# The same class as a plain character set (Java's \d is ASCII 0-9 only).
TOKEN_BREAK_CHARS = "[]\\,.;:º0123456789ª&`’´-_()¡\"!?¿{}=+<>|^“‘/$™%—•*”"
# Java's \s: the characters a token split breaks on.
JAVA_WHITESPACE = " \t\n\x0b\f\r"

# --- fixed values: English stopword list (176 words, in list order) ---------------------
STOPWORDS = (
    'a', 'have', 'under', 'off', 'both', "you've", 'than', 'now', 'for', 'being', 'all', 'on',
    'no', 'that', "isn't", 'themselves', 'the', 'before', 'hadn', 'their', 'her', "hadn't", 'll',
    'then', 'while', 'herself', 'he', 'once', 'why', 'she', 'whom', 'shan', 'down', 'can', 'with',
    'there', 'is', 'about', 'm', 'do', "haven't", 'ours', "wasn't", 'been', 'didn', 'if', 'don',
    'd', 'more', 'to', 'are', 'they', 'shouldn', 'myself', 'our', 'not', "mightn't", "she's",
    'but', 'above', 'too', 't', 'into', "wouldn't", 'such', 'who', 'here', 'him', 'its', 'as',
    'needn', 'this', 'himself', 'it', 'weren', 'an', "aren't", 'from', 've', 'very', 'isn', 'when',
    'won', 'should', 'where', 'your', 'am', 'couldn', 'up', 'itself', 'what', 'aren', 'haven',
    'over', 'o', 'how', 'ain', 'nor', 'was', 'yours', 'ourselves', 'below', 'does', 'did', 'other',
    'doesn', 'out', 'mightn', 'hers', 'and', 'only', 'so', 'his', 'most', "you're", 'hasn',
    "you'd", 'will', 'these', 'y', 'ma', 'wasn', 'after', 'by', 'just', 'during', "shan't",
    'between', "couldn't", 'having', "you'll", 'wouldn', 'any', 'yourself', "mustn't", 're',
    'which', 'some', 'were', "shouldn't", 'me', 'you', 'yourselves', 'own', 'doing', "needn't",
    'because', 'has', 'in', 'had', "didn't", 'my', "don't", "that'll", 'again', 'further', "won't",
    "doesn't", 'mustn', 'or', "it's", "hasn't", "weren't", 'of', 'them', 'those', 'i', 'few',
    'through', 'theirs', 'be', 'same', 'at', 'against', "should've", 'each',
)

# --- fixed values: header marker of a downloaded book ----------------------------------
# The first "***...***" that closes on the same line; the text up to its end is dropped.
HEADER_MARKER = r"\*\*\*.*?\*\*\*"

# --- fixed values: "TITLE by AUTHOR" heading split (greedy: the LAST " by ") -----------
TITLE_AUTHOR = r"(.*)\s+by\s+(.*)"

# --- fixed values: one "Key: value" pair of a metadata line -----------------------------
# A value is either a "Month d, yyyy" date or everything up to the next comma.
METADATA_PAIR = r"(\w+)\s*:\s*((?:\w+\s+\d{1,2},\s+\d{4})|[^,]+)"

# --- fixed values: metadata line template ----------------------------------------------
METADATA_TEMPLATE = "ID: %s, Title: %s, Author: %s, Release Date: %s, Language: %s"

# --- fixed values: languages recognised in a book page's table cells --------------------
LANGUAGES = ("English", "Spanish", "French", "German", "Italian", "Dutch", "Chinese",
             "Russian", "Japanese")

# --- fixed values: month names accepted by the lenient "MMM d, yyyy" date parse ---------
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August",
          "September", "October", "November", "December")
MONTHS_SHORT = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov",
                "Dec")

# --- fixed values: text-fragment stub sentence ------------------------------------------
FRAGMENT_STUB = "Sample text containing word %s in book %s"

# --- fixed values: crawl frontier (first listing page, last listing page, page step) ----
FRONTIER_FIRST = 0
FRONTIER_LAST = 2100
FRONTIER_STEP = 25

# --- fixed values: catalogue site root and link shapes ----------------------------------
BASE_URL = "https://www.gutenberg.org"
BOOK_LINK_PREFIX = "/ebooks/"
DOWNLOAD_ANCHOR_TEXT = "plain text utf-8"

# Unknown-value marker used by the crawler for missing metadata fields.
UNKNOWN = "Unknown"
