"""Small tables for the tests of the text operators."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
# Names that the operators use inside or return.
CLASH = ["_key", "_text", "_row", "spans", "kept", "key", "score", "_ids", "class_id", "start", "_who", "kinds"]


def documents(spark, texts, clash=False):
    """Rows (doc_id, text) or bare texts as documents, optionally with columns of clashing names."""
    rows = [(n, t) if not isinstance(t, tuple) else t for n, t in enumerate(texts)]
    full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    names, schema = [f.name for f in DOCS], DOCS
    if clash:
        schema = T.StructType(DOCS.fields + [T.StructField(c, T.StringType()) for c in CLASH])
        full = [(*r, *(["x"] * len(CLASH))) for r in full]
        names += CLASH
    return spark.createDataFrame(full, schema)


def prose(words: int, seed: int = 0) -> str:
    pick = random.Random(seed)
    syllables = ["the", "an", "ou", "ing", "re", "st", "ble", "ti", "é", "ö"]
    return " ".join("".join(pick.choice(syllables) for _ in range(pick.randint(1, 4))) for _ in range(words))


# NULL, empty, blank, tiny, repeated, very long.
AWKWARD = [None, "", "  \n\t ", "a", prose(40, 1), (4, prose(40, 1)), (None, prose(40, 1)), (None, None), prose(30_000, 2),
           "x" * 60_000, "\ud7ff \U0001f600 ok " * 20]
