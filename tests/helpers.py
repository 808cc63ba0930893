"""Helpers of the tests of the library; `tests/llm` has its own."""


def rows_of(df, *columns):
    """Rows as plain tuples in the order of the given columns."""
    chosen = df.select(*columns) if columns else df
    return [tuple(row) for row in chosen.collect()]
