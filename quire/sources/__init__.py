"""Readers: books (tables or text files), stopwords, catalogue lines, pages, driver tables."""
