"""Rows that every operator has to take."""

#: Null, empty and blank texts, one word, repeated rows and lines, other spaces, a null key and a null source.
ODD = (
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \n\t ", "en", "a"),
    (4, "word", "en", "b"),
    (5, "One two three four five six seven.\nOne two three four five six seven.\n\nend", "en", "b"),
    (5, "One two three four five six seven.\nOne two three four five six seven.\n\nend", "en", "b"),
    (6, "one two three four five six seven!", "de", None),
    (7, "a\x1cb\xa0c é ÉCOLE\r\nΣΑΣ <|endoftext|> 12,5", "fr", "c"),
    (None, "no key here at all, not one", "en", "c"),
    (8, "x" * 50_000, "en", "c"),
    (9, " ".join(f"w{i % 700}" for i in range(30_000)), "en", "c"),
)
