"""Rows that operators must take as they come."""


def odd_rows():
    """Null and repeated ids, null, empty and blank texts, ties, repeated rows, a very long text."""
    long = " ".join(f"w{i * i % 9973}" for i in range(40_000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two"), (6, long), (7, long), (7, long),
        (None, long), (None, None), (8, "é" * 500), (9, "é" * 500), (10, "a" * 2000), (11, "\x00\x01 \x0b x"),
        (12, None, None), (13, "plain words here", None),
    ]
