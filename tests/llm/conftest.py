from __future__ import annotations

import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, score double, size string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows and ids, and columns named like results."""
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    prose = [" ".join(rng.choice(words) for _ in range(rng.randint(60, 200))) for _ in range(60)]
    rows = [(i, t, "en", f"s{i % 3}", 1.0, "x") for i, t in enumerate(prose)]
    rows += [(100, None, None, None, None, None), (101, "", "en", "", 0.0, ""), (None, "some words here", "en", "s1", None, None),
             (102, "w " * 60_000, "de", "s2", 1.0, "y"), (103, "\n\n \t", "en", "s1", 1.0, "z")]
    rows += [(104, prose[0], "en", "s0", 1.0, "x")] * 4 + [(105, prose[1], None, "s0", 1.0, "x"), (105, prose[2] + " more", "fr", None, 1.0, "x")]
    return rows, spark.createDataFrame(rows, DOC_SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
