"""Helpers of the tests of the operators on training data."""

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: tuple((v is None, v) for v in r))


def prose(rng, n, vocabulary=5000):
    """Words that hardly ever repeat in the same order."""
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))
