"""Rows that operators on documents must take: nulls, blanks, ties, repeats, non-ASCII and very long texts."""

LONG = " ".join(f"w{k}x{k % 13}" for k in range(20_000))
ROWS = [
    (1, "Alpha beta gamma delta epsilon zeta"),
    (2, "alpha BETA gamma delta epsilon zeta"),
    (2, "alpha BETA gamma delta epsilon zeta"),
    (3, None),
    (4, ""),
    (5, " \t\n"),
    (6, "one two"),
    (7, "one two"),
    (None, "alpha beta gamma delta epsilon zeta"),
    (None, None),
    (8, "Ünïcode — naïve ÉCLAIR 漢字 😀 İstanbul"),
    (9, LONG),
    (10, LONG + " tail"),
    (-5, "one two"),
    (11, "a" * 5000),
]
