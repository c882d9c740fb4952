"""Shared rows of the tests."""
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor sit amet " * 20_000
PLAIN = "the quick brown fox jumps over the lazy dog near the old river bank every single morning"
NASTY = [
    (1, PLAIN, "en", "s", 1), (2, PLAIN, "en", "s", 1), (2, PLAIN, "en", "s", 1), (3, None, "en", None, None),
    (4, "", None, "s", 0), (5, "  \n\t ", "en", "s", 4), (None, PLAIN + " again", None, "s", 2),
    (6, LONG, "la", "s", 9), (7, "Ünïcödé straße İstanbul ΑΣ 東京 👍", "xx", "s", 3), (8, "one", "en", "s", 3),
]
