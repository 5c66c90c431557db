"""Rows that every document operator must bear."""

LONG = " ".join(f"w{i * 7919 % 5003}" for i in range(30_000))
#: Nulls in any column, empty and very long texts, ties and repeated rows.
EDGES = [
    (1, "one two three four five six", "a"),
    (1, "one two three four five six", "a"),
    (2, None, "a"),
    (3, "", None),
    (4, " \t\n", None),
    (None, "no id here", "b"),
    (None, None, None),
    (5, LONG, "b"),
    (6, "One Two three four five six", "b"),
    (7, "7 seven", "c"),
]
