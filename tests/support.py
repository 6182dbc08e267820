"""Helpers shared by the test modules (imported by name, unlike conftest)."""


def rows(df, *cols):
    """Collect small test results as sorted tuples."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
