"""Small tables with the odd cases: nulls, empty and long texts, ties, repeated rows, copies, and columns with clashing names."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, ids string, key string, shard string, kept string"


def words(rng: random.Random, n: int, size: int = 4000) -> list[str]:
    return ["w%x" % int(size * rng.random() ** 3) + rng.choice(["", "", "", "é", ",", "."]) for _ in range(n)]


def texts() -> list[str | None]:
    rng = random.Random(7)
    out: list[str | None] = [None, "", " \n\t ", "one", "One two", "one  two\nthree", "a b c d", "A b C d", "<|endoftext|> x \\ y"]
    base = words(rng, 300)
    passage = words(rng, 60)
    out += [" ".join(base)] * 4
    for k in range(25):  # near copies, from one edit to many
        w = base[:]
        for _ in range(1 + k // 2):
            w[rng.randrange(len(w))] = f"edit{rng.random()}"
        out.append(" ".join(w))
    for k in range(12):  # a passage inside other texts
        out.append(" ".join(words(rng, 40 + 9 * k) + passage[: 60 - k] + words(rng, 30)))
    out += [" ".join(passage * 3), " ".join(["same"] * 90), "\n".join([" ".join(words(rng, 12))] * 5), " ".join(words(rng, 6000))]
    for k in range(12):  # small sets
        w = words(rng, 9 + k)
        out += [" ".join(w), " ".join(w + ["more"]), " ".join(w[:-1] + ["else"])]
    out += [" ".join(words(rng, rng.randrange(1, 80))) for _ in range(40)]
    return out


def documents(spark):
    rng = random.Random(3)
    rows = [(5 * i + 3, t) for i, t in enumerate(texts())]
    rng.shuffle(rows)
    return spark.createDataFrame([(i, t, "en", None, None, "x", "x", "x", "x", "x") for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def sf(spark, tmp_path_factory):
    """A folder with the tables that the queries read."""
    root = str(tmp_path_factory.mktemp("tables"))
    documents(spark).repartition(3).write.parquet(f"{root}/documents.parquet")
    return root


@pytest.fixture(scope="session")
def rows(spark, sf):
    return sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with null ids and repeated rows."""
    t = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    return spark.createDataFrame([(None, t), (None, None), (4, t), (4, t), (4, "other text"), (2, t + " more"), (9, None)], "doc_id bigint, text string")


@pytest.fixture(scope="session")
def none(spark, tmp_path_factory):
    """A folder of empty tables."""
    root = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([], "page_id bigint, url string, html string").write.parquet(f"{root}/pages.parquet")
    spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{root}/conversations.parquet")
    return root
