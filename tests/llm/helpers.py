"""Small tables for the operators' edge cases, written as Parquet so that they can be read again."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Columns whose names clash with the operators' own, besides the two that are read.
EXTRA = ["at", "h", "node", "digest", "key", "bucket", "n", "text_sha256", "kept", "ids", "lang", "source"]


def prose(rng: random.Random, n: int, vocabulary: int = 3000) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def table(spark, tmp_path, rows, name="docs", parts=3):
    """(doc_id, text) rows with the extra columns, in a few files."""
    schema = "doc_id long, text string, " + ", ".join(f"{c} string" for c in EXTRA)
    df = spark.createDataFrame([(i, t, *[f"{c}-{i}" for c in EXTRA]) for i, t in rows], schema)
    path = str(tmp_path / name)
    df.repartition(parts).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def edge_rows():
    """Null and empty texts, null ids, repeated rows, ties, white space, a very long text and copies."""
    rng = random.Random(5)
    long = prose(rng, 30_000)
    body = prose(rng, 60)
    return [
        (1, body), (2, body), (3, body + " more"), (4, None), (5, ""), (6, None), (7, "   \n\t\n "), (8, "one"),
        (9, "Two words"), (9, "Two words"), (None, "no id"), (None, body), (10, long), (11, long + " end"),
        (12, "line\nLINE \nother\n\nline"), (13, "\n"), (14, "é ç ß 漢字 🙂"), (15, "### $$$ %%%"), (16, prose(rng, 200)),
    ]
