"""Small documents with every odd case: nulls, empties, long texts, ties,
repeated rows, clashing extra columns."""

import random

from pyspark.sql import types as t

SCHEMA = t.StructType([t.StructField("doc_id", t.LongType()), t.StructField("text", t.StringType()), t.StructField("lang", t.StringType()),
                       t.StructField("source", t.StringType()), t.StructField("n_chars", t.LongType()),
                       t.StructField("labels", t.StringType()), t.StructField("score", t.StringType()), t.StructField("sig", t.StringType()),
                       t.StructField("component_id", t.StringType()), t.StructField("shard", t.StringType())])


def frame(spark, rows):
    """``rows`` of (doc_id, text); the other columns clash with outputs."""
    full = [(i, x, "en", None, len(x) if x is not None else None, "x", "y", "z", "c", "s") for i, x in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}é" if rng.random() < 0.1 else f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_rows(seed: int = 7) -> list[tuple]:
    rng = random.Random(seed)
    base, passage = prose(rng, 120), prose(rng, 70)
    rows = [(i, prose(rng, rng.randrange(1, 200))) for i in range(30)]
    rows += [(100 + i, base) for i in range(4)] + [(200, base.replace("w1 ", "w2 ", 1)), (201, base + " tail")]
    rows += [(300 + i, prose(rng, 40) + " " + passage + "\n" + prose(rng, 5 + i)) for i in range(6)]
    words = base.split()
    for i in range(8):
        near = list(words)
        near[rng.randrange(120)] = f"edit{i}"
        rows.append((400 + i, " ".join(near)))
    rows += [(500, ""), (501, None), (502, "one"), (503, "two words"), (504, " \n\t "), (505, "Two Words"), (506, "a b c"), (507, "A\tB\nC")]
    rows += [(None, base), (None, None), (100, base), (100, base), (600, prose(rng, 6000)), (601, "x" * 50_000), (602, "中文 текст é́ " * 30), (-5, base + " end")]
    rng.shuffle(rows)
    return rows
