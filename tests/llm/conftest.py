import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskrules.llm.common import prepared  # noqa: E402

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (id, text) or full rows, in several partitions."""

    def make(rows, extra=()):
        prepared(spark)
        full = [tuple(r) + ("en", "s", len(r[1] or ""))[len(r) - 2 :] for r in rows]
        df = spark.createDataFrame([r + tuple(0 for _ in extra) for r in full], DOCUMENT + "".join(f", `{c}` int" for c in extra))
        return df.repartition(3) if rows else df

    return make


@pytest.fixture
def sentences():
    """A seeded maker of texts over a small vocabulary."""
    rng = random.Random(5)
    words = ["".join(rng.choice("aeinorstlm") for _ in range(rng.randint(2, 8))) for _ in range(400)]

    def make(n, seed=None):
        r = rng if seed is None else random.Random(seed)
        return " ".join(r.choice(words) for _ in range(n))

    return make

