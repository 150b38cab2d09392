from __future__ import annotations

import random
import tracemalloc

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, node long"
WORDS = [a + b for a in ("ba", "ko", "ri", "tu", "se", "mo") for b in ("ra", "ne", "li", "do", "pu")]


def prose(seed: int, count: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(WORDS, k=rng.randint(1, 3))) for _ in range(count))


def peak_of(call):
    """What ``call`` returns, and the bytes it held at most."""
    tracemalloc.start()
    try:
        return call(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def document_rows() -> list[tuple]:
    """Prose, copies, near copies, shared passages, ties, nulls, empty and long texts."""
    base, passage = prose(1, 120), prose(2, 90)
    words = base.split()
    near = [" ".join([*words[:k], "changed", *words[k + 1 :]]) for k in (3, 60, 118)]
    texts = [
        base,
        base,
        base.replace(" ", "  "),
        base.replace(" ", "\n"),
        base.upper(),
        *near,
        prose(3, 40) + " " + passage + " " + prose(4, 40),
        prose(5, 10) + " " + passage + " " + prose(6, 200),
        passage,
        "",
        "",
        None,
        None,
        " \t\n",
        "word",
        "Word",
        "two words",
        "one two three four five",
        "a" * 900,
        "ab" * 700,
        "é" * 250 + "\U0001f600" * 50,
        prose(7, 4000),
        prose(7, 4000)[:-9],
        *(prose(100 + k, 30 + 7 * k) for k in range(15)),
    ]
    rows = [
        (k, t, ("en", "fr", None)[k % 3], f"s{k % 4}", len(t or ""), "clash", k)
        for k, t in enumerate(texts)
    ]
    rows += [rows[0], rows[5], rows[11]]  # whole rows once more
    rows += [(None, base, None, None, None, None, None), (None, prose(300, 50), "en", "s1", 1, "", 2)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return document_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
