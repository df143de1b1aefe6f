import collections
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import line_dedup
from strata.llm.common import table

from .brute import lower
from .conftest import rows_of

SMALL = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"


def plain_version(rows, min_docs=10, min_chars=1, keep="none"):
    def key(line):
        return lower(line).strip(SPACE)

    texts = [(i, (t or "").split("\n")) for i, t in rows]
    held = collections.Counter(k for _, lines in texts for k in {key(x) for x in lines})
    gone = {k for k, n in held.items() if n >= min_docs and len(k) >= min_chars and k}
    first = {}
    for i, lines in sorted(texts, key=lambda x: (x[0] is None, x[0] or 0)):
        for at, line in enumerate(lines):
            first.setdefault(key(line), (i, at))
    out = []
    for i, lines in texts:
        left = [x for at, x in enumerate(lines) if key(x) not in gone or keep == "first" and first[key(x)] == (i, at)]
        out.append((i, len(lines), len(lines) - len(left), hashlib.sha256("\n".join(left).encode()).hexdigest()))
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


@pytest.fixture(scope="module")
def line_rows(doc_rows):
    rows = list(doc_rows)
    rows += [(1000 + k, f"own {k}\n  Shared LINE \r\nmore {k % 3}\n\n\tÉcole é\x0b\nx") for k in range(12)]
    rows += [(1100 + k, f"nine {k}\nnine times\nÉcole É") for k in range(9)]
    rows += [(1200, "shared line\nshared line\nSHARED LINE"), (1201, "only \nshared line "), (1202, "x\nx")]
    return rows + [(None, "shared line\nno id")]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    return df.withColumns({c: F.lit("extra") for c in ("key", "chunk", "number", "first", "n_lines", "verdicts")})


def test_lines_match_brute_force_on_edge_cases(spark, line_rows):
    got = rows_of(line_dedup.report(line_dedup.drop_repeated_lines(frame(spark, line_rows))))
    assert got == plain_version(line_rows)
    assert max(r[2] for r in got) == 3


@pytest.mark.parametrize("min_docs, min_chars", [(2, 1), (9, 5), (3, 2)])
def test_other_bounds(spark, line_rows, min_docs, min_chars):
    got = line_dedup.drop_repeated_lines(frame(spark, line_rows), min_docs=min_docs, min_chars=min_chars)
    assert rows_of(line_dedup.report(got)) == plain_version(line_rows, min_docs, min_chars)


def test_first_occurrence_stays(spark, line_rows):
    rows = [r for r in line_rows if r[0] is not None]
    rows = list({i: (i, t) for i, t in rows}.values())
    got = line_dedup.drop_repeated_lines(frame(spark, rows), min_docs=2, keep="first")
    assert rows_of(line_dedup.report(got)) == plain_version(rows, 2, keep="first")


def test_small_chunks_and_many_segments(spark, line_rows, monkeypatch):
    """Every document a chunk of its own, and texts far longer than a chunk."""
    monkeypatch.setattr(line_dedup, "CHUNK_BYTES", 100)
    monkeypatch.setattr(line_dedup, "SEGMENT_BYTES", 300)
    rows = line_rows + [(5000, "\n".join(f"line {k}" for k in range(30_000)) + "\nshared line")]
    assert rows_of(line_dedup.report(line_dedup.drop_repeated_lines(frame(spark, rows)))) == plain_version(rows)


def test_lines_match_brute_force_on_documents(spark):
    docs = table(spark, SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert rows_of(line_dedup.report(line_dedup.drop_repeated_lines(docs))) == plain_version(rows)


def test_filters_err_on_one_side_only():
    r = np.random.default_rng(3)
    h = r.integers(0, 1 << 32, 50_000).astype(np.uint32)
    bloom = line_dedup.Bloom(len(h))
    bloom.add(bloom.places(h))
    assert bloom.holds(bloom.places(h)).all()
    other = r.integers(0, 1 << 32, 50_000).astype(np.uint32)
    assert bloom.holds(bloom.places(other)).mean() < 0.02


def test_only_suspected_repeats_are_shuffled_as_lines(spark):
    rows = [(k, f"line of its own {k}\nanother {k}\ntwice {k // 2}") for k in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    packed = line_dedup.chunks(docs, "doc_id", "text", 4000)
    found = line_dedup.suspects(packed, 5).select("key").distinct().collect()
    keys = {bytes(r.key).decode() for r in found}
    assert {f"twice {k}" for k in range(1000)} <= keys
    assert len(keys) < 1000 + 4000 * 0.03


def test_empty_table(no_docs):
    out = line_dedup.report(line_dedup.drop_repeated_lines(no_docs))
    assert out.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    assert out.count() == 0
    with pytest.raises(ValueError, match="line dedup"):
        line_dedup.drop_repeated_lines(no_docs, min_docs=1)


def test_a_chunk_holds_two_megabytes_at_most(spark):
    """Each worker holds a chunk's lines and keys at once, so its size bounds an executor's memory."""
    from strata.llm.suffix_dedup import chunks

    docs = spark.range(0, 60, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.col("id").cast("string"), F.lit("\nshared line\n")), 7000).alias("text"))
    packed = chunks(docs, "doc_id", "text", line_dedup.CHUNK_BYTES)
    assert max(r.n_bytes for r in packed.select("n_bytes").collect()) <= 2 << 20
    got = {r.doc_id: r for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert len(got) == 60 and all("shared" not in r.text and r.n_dropped >= 7000 for r in got.values())
