from __future__ import annotations

import random

import pytest

WORDS = ["the", "And", "of", "thion", "EAUX", "é", "ßst", "x.", "|", "a,b", "naïve", "日本", "Ö!", "12"]


def make_text(rng: random.Random, n: int) -> str:
    gaps = [" ", " ", " ", "\n", "  ", "\t", ". ", ".\n", "\u00a0", "\x0b"]
    return "".join(rng.choice(WORDS) + rng.choice(gaps) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Documents with nulls, empty and long texts, ties, copies and near copies."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    long = " ".join(rng.choice(words) for _ in range(4000))
    body = [" ".join(rng.choice(words) for _ in range(120)) for _ in range(6)]
    near = body[0].split(" ")
    texts = [None, "", " \n\t ", "one", "two words", "a b c d", long, long, body[0], body[0],
             " ".join(near[:60] + ["changed"] + near[61:]), body[1] + "\n" + body[2], body[2].upper(),
             body[2], body[3] + " " + body[4], body[5] + " " + body[3], "word " * 80, "\n\n\n", "é" * 50]
    texts += [make_text(rng, rng.randint(1, 200)) for _ in range(40)]
    return [(i, t, ["en", "fr", None][i % 3], [f"src{i % 4}", None][i % 11 == 5], len(t or ""))
            for i, t in enumerate(texts)]


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def as_table(spark, folder, df, name="documents"):
    """A folder with the table, as the registered queries read it."""
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)
