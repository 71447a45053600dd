"""Small tables with every awkward row: nulls, empty and very long texts, repeats, ties."""

import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(["ab", "ce", "di", "fo", "gu", "zy"]) for _ in range(
        draw.randint(1, 3))) for _ in range(words))


def awkward_texts() -> list[str | None]:
    base = prose(1, 60)
    words = base.split()
    near = " ".join([*words[:-1], "changed"])
    return [
        base, base, base.upper(), near, " ".join(words[:30] + ["x"] + words[31:]),
        None, "", " \t\n ", "one two", "one  TWO", "!!! ### 123", prose(2, 3000),
        prose(2, 2999) + " tail", prose(3, 5), prose(3, 4), "é ñ ß 漢字 \U0001f600 mixed", "a" * 70_000,
        "mail me at a.b@c.de or x@y, 10.0.0.1, +49 30 1234567, 4111 1111 1111 1111"]


@pytest.fixture(scope="session")
def awkward(spark):
    rows = [(i, t, ["en", "de", None][i % 3], [None, "a", "b"][i % 3], 0)
            for i, t in enumerate(awkward_texts())]
    rows += [rows[0], (None, "null id text here", "en", "a", 1), (None, None, None, None, None)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.fixture(scope="session")
def crowded(spark, awkward):
    """The same with columns whose names operators use themselves."""
    extra = {n: awkward["n_chars"] for n in (
        "node", "key", "record", "size", "piece", "shard", "item", "component", "_key", "rank")}
    return awkward.withColumns(extra)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
