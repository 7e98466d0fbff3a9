"""Rows of a DataFrame in an order that does not depend on the plan."""


def rows(df, *cols):
    """Sorted tuples of the given columns (all columns when none given)."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
