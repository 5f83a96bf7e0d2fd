"""Data and helpers of these tests."""

from __future__ import annotations

SF = "/root/testdata/sf0.01"
WORDS = "the of and that erin onth wash ble tion rest hea ing oned anth shou reti".split()


def prose(seed: int, n: int) -> str:
    """``n`` invented words, reproducible."""
    import random
    r = random.Random(seed)
    return " ".join("".join(r.choices(WORDS, k=r.randint(1, 3))) for _ in range(n))


#: Nulls, empty and long texts, ties, repeated rows; columns whose names operators use themselves.
EDGE = [(1, prose(1, 80), "en", "x", 1), (2, prose(1, 80), "en", "x", 2), (2, prose(1, 80), "en", "x", 2), (3, None, None, None, None),
        (4, "", "en", "", 0), (5, " \n\t ", "de", "s", 3), (None, prose(2, 60), "en", None, 4), (6, "one two", None, "s", 5),
        (7, prose(3, 30_000), "en", "s", 6), (8, prose(4, 70) + " \u00e9\u00e8 \U0001f600 \u4e2d\u6587", "fr", "s", 7), (9, prose(1, 79) + " changed", "en", "s", 8)]
EXTRA = ("n_words", "kept", "row", "id", "state", "hits", "n", "key", "doc", "spans", "fold", "h", "part", "file", "start", "text_a", "digest")


def rows(df, *columns):
    got = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(got, key=lambda t: tuple((x is None, str(x)) for x in t))
