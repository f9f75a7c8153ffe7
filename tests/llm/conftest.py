import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and very long texts, ties, repeated rows, copies, short passages that several texts share."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, common = prose(60), prose(45)
    rows = [
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \t\n\x0b\x0c\r ", None, None, 7),
        (4, "word", "en", None, 4),
        (5, prose(3_000), "en", "a", 0),
        (6, prose(50) + " " + passage + " " + prose(50), "en", "b", 0),
        (7, prose(20) + "\n" + passage + "\t" + prose(70), "de", "b", 0),
        (8, prose(40) + "  " + passage, "de", None, 0),
        (9, "tick tock " * 60, "de", "a", 0),
        (None, common, "en", "a", 0),
        (None, common + " end", "en", "a", 0),
        (12, "É è ß — Ünïcödé ÀÉ 漢字 и 🙂 " * 12, "fr", "ü", 0),
        (13, "1234 5678 -- !!", "en", "c", 0),
        (14, "A B", "fr", "c", 0),
    ]
    copy = prose(80)
    rows += [(n, copy, "en", "a", 0) for n in range(20, 32)]
    rows += [(n, copy.upper() + f" {n}", "en", "a", 0) for n in range(32, 40)]
    rows += [(n, prose(rng.randint(1, 40)) + " " + common + " " + prose(rng.randint(1, 90)), rng.choice(["en", "de"]), "hot", 0) for n in range(40, 90)]
    rows += [rows[5], rows[5], (6, "other text of a repeated id", "en", "b", 0)]
    return [(*r[:4], len(r[1] or "")) for r in rows]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def crowded(edge_docs):
    """The same with further columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    names = "score size taken target spans keys key h fp words text_hash start n at bucket kind content _text left right".split()
    return edge_docs.select("*", *[F.lit("x").alias(n) for n in names])


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
