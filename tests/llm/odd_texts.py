"""Texts that every operator has to bear."""

LONG = " ".join(f"w{k % 977}x{k % 31}" for k in range(60_000))
ODD_TEXTS = [
    (1, None),
    (2, ""),
    (3, "   \n\t "),
    (4, "one two three four five six seven eight nine ten eleven twelve"),
    (5, "one two three four five six seven eight nine ten eleven twelve"),
    (5, "one two three four five six seven eight nine ten eleven twelve"),
    (6, "few words"),
    (7, "FEW words"),
    (8, LONG),
    (None, "a row without an id, with some more words in it"),
    (9, "!!! ??? ***"),
    (10, "one two three four five six seven eight nine ten eleven twelve thirteen"),
    (11, "ünï çødé 你好 мир ñ"),
    (12, " tab\tand\x0bvertical\x0cfeed\rreturn"),
]
