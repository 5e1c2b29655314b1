"""Small tables for the operators' tests."""

import random

#: Columns whose names an operator might use itself.
CLASH = ("id", "h", "n_words", "shard", "size", "__hits", "token", "component_id")


def docs_frame(spark, rows, extra=CLASH):
    """rows: (doc_id, text); the other columns of ``documents`` and clashing names are added."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
        f"{c} string" for c in extra)
    return spark.createDataFrame([(i, t, None, "s", None, *["x"] * len(extra)) for i, t in rows], schema)


def prose(seed, n_words, vocabulary=300):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abdeéimnorstu") for _ in range(rng.randint(2, 7))) for _ in range(vocabulary)]
    out = []
    for i in range(n_words):
        out.append(rng.choice(words) + rng.choice(["", "", "", "", ",", ".", ".\n"]))
    return " ".join(out)


def edge_docs():
    """Nulls, empty, blank and very long texts, repeated rows, copies, a null id."""
    a, b = prose(1, 120), prose(2, 300)
    return [(1, a), (2, None), (3, ""), (4, " \n\t "), (5, b), (5, b), (6, a), (None, prose(3, 80)), (None, None),
            (7, "x" * 150_000), (8, prose(4, 30_000)), (9, (prose(5, 9) + "\n") * 12), (10, "Ünï 日本語 # * $"),
            (-3, b + " more")]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
