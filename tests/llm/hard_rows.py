import json

import pytest


def plain(df):
    """Rows as dictionaries, in a fixed order."""
    return sorted((r.asDict(recursive=True) for r in df.collect()), key=lambda r: json.dumps(r, sort_keys=True, default=str))


@pytest.fixture(scope="session")
def documents(spark):
    """Nulls in every column, empty and very long texts, repeated rows, columns with clashing names."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, `n.x` int, size int, pid int, shard string"
    base = "the quick brown fox jumps over the lazy dog and runs far away from the old grey wolf in the dark wood "
    rows = [
        (1, base * 3, "en", "a", 1, 1, 1, 1, "x"), (1, base * 3, "en", "a", 1, 1, 1, 1, "x"), (2, base * 3, "en", None, None, None, None, None, None),
        (3, None, "de", "b", None, 1, 1, 1, "x"), (4, "", None, "b", 0, 1, 1, 1, "x"), (5, "one two", "en", "c", 7, 1, 1, 1, "x"),
        (6, base * 2000, "en", "c", 1, 1, 1, 1, "x"), (7, "été über $$$ \U0001f600", "fr", "ß", 1, 1, 1, 1, "x"),
        (None, "no id at all", "en", "a", 1, 1, 1, 1, "x"), (None, None, None, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, schema)
