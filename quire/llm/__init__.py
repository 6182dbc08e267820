"""Training-data operators: archives, dedup, counting, search, formatting, filtering, mixing.

Each module holds one operator and says in its docstring what nulls, empty and very long
texts, ties, repeated rows, empty tables and extra columns give.  Nothing outside this
subpackage imports it; ``queries.py`` lists the registered queries.
"""
