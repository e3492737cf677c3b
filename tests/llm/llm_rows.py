"""Rows that the operator tests share."""

import os

SMALL = os.environ.get("LLM_TEST_SF", "/root/testdata/sf0.001")
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids."""
    long = " ".join(f"word{k % 977} of the long text" for k in range(12_000))
    return [
        (1, None, "en", "a", 0), (2, "", None, None, None), (3, " \n\t ", "en", "a", 4),
        (None, "Text without an id, long enough to have several words in it.", "en", "a", 10),
        (None, None, None, None, None), (4, long, "en", "a", len(long)), (5, long, "en", "b", len(long)),
        (6, "same row " * 30, "de", "a", 270), (6, "same row " * 30, "de", "a", 270),
        (7, "one id", "de", "a", 6), (7, "two texts under one id", "de", "a", 22),
        (8, "<|endoftext|> mail a.b@c.de now +49 (0)30 1234567 or 10.0.0.1 \U0001F600 \x00", "fr", "a", 9)]
