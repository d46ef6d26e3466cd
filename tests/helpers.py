"""What several test modules use."""


def rows(df, *columns):
    """Sorted tuples of a small result."""
    names = columns or df.columns
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
