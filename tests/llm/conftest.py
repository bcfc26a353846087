import numpy as np
import pytest


@pytest.fixture()
def make(spark):
    """A documents table (with an extra column of a clashing name) from (doc_id, text) or (doc_id, text, lang) rows."""

    def build(rows, schema="doc_id long, text string, lang string, source string, n_chars long, id string"):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or ""), "clash") for r in rows]
        return spark.createDataFrame(full, schema)

    return build


@pytest.fixture()
def words():
    """words(n, seed): n made-up words."""

    def build(n, seed=0):
        rng = np.random.default_rng(seed)
        parts = ["ba", "ko", "ri", "tu", "shel", "mon", "der", "vis"]
        return ["".join(parts[i] for i in rng.integers(0, len(parts), rng.integers(2, 5))) for _ in range(n)]

    return build
