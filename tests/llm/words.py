"""Rows with awkward texts that every operator has to take."""

LONG = " ".join(f"word{i % 977}" for i in range(30_000))
AWKWARD = [
    (1, "The quick brown fox. The lazy dog sleeps, and the fox runs on and on today."),
    (2, None),
    (3, ""),
    (4, " \t\n\x0b\f\r "),
    (5, LONG),
    (6, "x" * 50_000),
    (7, "é▁日本\U0001F600 ÀÉ İstanbul ﬁn\n\nß straße"),
    (8, "The quick brown fox. The lazy dog sleeps, and the fox runs on and on today."),
    (8, "The quick brown fox. The lazy dog sleeps, and the fox runs on and on today."),
    (None, "No id here but some words that nobody else has written down so far."),
    (9, "a a a a a a a a a a a a\na a a a a a a a a a a a\n"),
]
# Column names that the operators use inside.
EXTRA = ["row", "key", "at", "n", "fp", "w", "_row", "size", "kind", "score", "words", "_stats", "block", "held_out"]


def awkward_docs(spark, rows=None):
    names = ["doc_id bigint", "text string", "lang string", "source string", "n_chars bigint"] + [f"{c} string" for c in EXTRA]
    data = [
        (i, t, None if n % 4 == 0 else "en", None if n % 3 == 0 else "s", None, *["z"] * len(EXTRA))
        for n, (i, t) in enumerate(AWKWARD if rows is None else rows)
    ]
    return spark.createDataFrame(data, ", ".join(names))


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
