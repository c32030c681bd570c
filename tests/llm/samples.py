"""Small tables for the text operators."""

import random

import pyarrow as pa

WORDS = "alder birch cedar dogwood elm fir gorse hazel iris juniper kale larch maple nettle oak pine quince rowan spruce thyme ulex vine willow yarrow zinnia".split()


def docs(spark, rows):
    """doc_id and text, with extra columns whose names operators use themselves."""
    n = len(rows)
    table = pa.table(
        {
            "doc_id": pa.array([r[0] for r in rows], pa.int64()),
            "text": pa.array([r[1] for r in rows], pa.string()),
            "lang": pa.array([r[2] if len(r) > 2 else None for r in rows], pa.string()),
            "n_chars": pa.array([None if r[1] is None else len(r[1]) for r in rows], pa.int64()),
            "text_key": pa.array(["mine"] * n, pa.string()),
            "score": pa.array([None] * n, pa.float64()),
            "dropped": pa.array([True] * n, pa.bool_()),
            "row": pa.array([7] * n, pa.int32()),
            "kept": pa.array(["x"] * n, pa.string()),
        }
    )
    return spark.createDataFrame(table)


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def generator(seed):
    return random.Random(seed)
