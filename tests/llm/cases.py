"""Awkward tables that every operator has to take."""

SCHEMA = "doc_id long, text string, n long, score double, component string, kind string, words string"
LONG = "lorem Ipsum, dolor sit amet. " * 12_000  # 350,000 letters


def frame(spark, rows, parts=3):
    """Rows (doc_id, text) with further columns whose names operators use themselves."""
    full = [(i, t, 7, 0.5, "x", "y", "z") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def awkward(spark):
    rows = [
        (1, "One two three four five six seven."),
        (2, None),
        (3, ""),
        (4, " \n\t "),
        (5, "ONE two three four five six seven."),
        (5, "ONE two three four five six seven."),
        (6, LONG),
        (7, LONG.upper()),
        (None, "a row without an id"),
        (8, "İstanbul ΣΑΣ ﬁ é x\x1cy ² 東京 <|endoftext|> don't 12ab ..."),
        (9, "x" * 100_000),
        (10, "mail a@b.example.com or +1 (555) 555-0100, 4111 1111 1111 1111, 10.0.0.256 10.0.0.25"),
    ]
    return frame(spark, rows)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
