"""Column expressions (JVM-side, whole-stage-codegen friendly) for text, HTML and metadata."""

from quire.functions.text import (  # noqa: F401
    book_id_from_path, doc_key_from_path, java_trim, normalize_separators, parse_query,
    strip_header, tokenize,
)
from quire.functions.html import (  # noqa: F401
    absolute_url, body_text, book_links, download_link, heading, html_text, language_cell,
    link_book_id, release_date, split_author, split_title,
)
from quire.functions.metadata import (  # noqa: F401
    format_metadata_line, metadata_field, metadata_fields, metadata_id, release_year,
)
from quire.functions.arrays import flatten_positions, join_ints, positions_text  # noqa: F401
