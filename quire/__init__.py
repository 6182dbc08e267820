"""quire — a Spark-native positional full-text index and conjunctive search engine.

Books are rows of a DataFrame; tokenizing, indexing, metadata parsing and searching are
DataFrame/SQL plans that Catalyst optimizes and Spark distributes.  See README.md.
"""

__version__ = "0.1.0"
