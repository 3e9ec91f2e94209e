"""Shared by the library's tests."""

SF_SMALL = "/root/testdata/sf0.001"


def rows(df, *cols):
    """Collect as sorted tuples of the given columns (or all columns)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple(str(x) for x in t))
