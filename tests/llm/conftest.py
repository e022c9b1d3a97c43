import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, part int, node binary, key string, `row` int, length bigint"


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdeéß") for _ in range(r.randint(1, 7))) for _ in range(words))


def rows() -> list[tuple]:
    """Nulls in every column, empty and blank texts, a very long one, equal texts, near copies, repeated rows, clashing names."""
    base = prose(1, 80)
    near = base.split(" ")
    near[40] = "changed"
    texts = {
        1: base, 2: base.upper().replace("É", "é"), 3: " ".join(near), 4: None, 5: "", 6: "  \n\t ", 7: "one two", 8: "ONE two", 9: prose(2, 30_000),
        10: prose(3, 120), 11: base, 12: "Licensed under the Apache License, Version 2.0.\nThe MIT License and the mit license.", 13: "😀 ünï 中 ▁",
        14: "a line that is long enough to count\nanother line that is long enough\nshort",
        15: "a line that is long enough to count\nanother lime that is long enough!\nshort",
        16: "\n".join(["a line that is long enough to count"] * 3),
    }
    out = [(i, t, "en", "s", None if t is None else len(t), 0, b"x", "k", i, 7) for i, t in texts.items()]
    out += [(None, base, None, None, None, None, None, None, None, None), (10, prose(3, 120), "en", "s", 1, 0, b"x", "k", 10, 7)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
