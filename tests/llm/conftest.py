import pytest

#: Texts with every awkward shape: null, empty, blank, no letters, one word, control strings, other scripts, long.
ODD = [
    None, "", " \t\n", "...", "word", "four words are here", "five words are here now", "<turn user>\n</turn>\n \\b \\l", "日本語のテキスト です", "Привет мир это текст",
    "a" * 5000, "ab " * 3000, "é ß\x85x", "The same text of more than five words here.", "The same text of more than five words here.", "  The same text of more than five words\nhere. ",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd texts with a null id, a repeated row and columns whose names operators use themselves."""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(ODD)]
    rows += [(None, "a row without an id that has some words", None, None, None), (3, "...", "en", "s", 3), (3, "...", "en", "s", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", "1 as block", "'x' as digest", "2 as rep", "3 as label", "4 as token", "'k' as kept", "5 as _scored", "6 as extra", "7 as _gone", "8 as part", "9 as rank")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
