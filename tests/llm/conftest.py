import random

import pytest
from pyspark.sql import functions as F

# Names that the operators use inside; documents may bring columns of the same names.
CLASHES = ["ws", "hs", "bucket", "rn", "chunk", "key", "cls", "text_hash", "bad_id", "gone_id", "factor_", "w", "spans", "start"]


def make_rows():
    """Documents with copies, near copies, shared passages, ties, nulls and one long text."""
    r = random.Random(5)
    words = ["the", "of", "and"] + ["".join(r.choice("abcdeéß") for _ in range(r.randint(3, 9))) for _ in range(400)]

    def prose(n):
        return " ".join(r.choice(words) for _ in range(n))

    base = prose(120)
    shared = prose(40)
    rows = [(i, prose(r.randint(1, 90))) for i in range(1, 30)]
    rows += [(40, base), (41, base), (42, base.upper()), (43, base + " one more"), (44, base.replace(" ", "\n\t"))]
    rows += [(50 + k, f"{prose(15)} {shared} {prose(15)}") for k in range(6)]
    rows += [(60, ""), (61, None), (62, " \n "), (63, "one two"), (64, "One TWO"), (65, "x" * 700), (66, "ab" * 300), (67, "et " * 200)]
    rows += [(70, base), (70, base), (70, prose(30)), (None, prose(40)), (None, base), (None, None)]
    rows += [(80, prose(6000)), (81, "a\x00b " * 60), (82, "ééé" * 80), (83, "%%% !!! ,,,")]
    return rows


@pytest.fixture(scope="session")
def doc_rows():
    return make_rows()


@pytest.fixture(scope="session")
def edge_docs(spark, doc_rows):
    """Over several partitions, with extra columns of clashing names."""
    langs = [(i, t, ["en", "fr", None][k % 3], f"src{k % 4}", None if t is None else len(t)) for k, (i, t) in enumerate(doc_rows)]
    df = spark.createDataFrame(langs, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(5)
    return df.withColumns({c: F.lit("extra") for c in CLASHES})


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


@pytest.fixture(scope="session")
def as_rows():
    return rows_of
