import hashlib

import pytest
from pyspark.sql import functions as F

from strata.llm import fim
from strata.llm.common import table

from .conftest import rows_of

SMALL = "/root/testdata/sf0.001"


def plain_version(rows, sentinels=fim.SENTINELS):
    p, s, m = sentinels
    out = []
    for i, t in rows:
        t = t or ""
        n = len(t)
        digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
        h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
        a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        if not t or any(x in t for x in sentinels) or h[2] % 100 >= 90:
            out.append((i, n, "plain", None, None, t))
        elif h[3] % 100 < 20:
            out.append((i, n, "spm", a, b - a, s + t[b:] + p + t[:a] + m + t[a:b]))
        else:
            out.append((i, n, "psm", a, b - a, p + t[:a] + s + t[b:] + m + t[a:b]))
    return out


def in_order(rows):
    return sorted(rows, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def test_outputs_match_brute_force_on_edge_cases(edge_docs, doc_rows):
    got = rows_of(fim.transform(edge_docs.withColumns({"n": F.lit("extra"), "h1": F.lit("extra"), "output": F.lit("extra")})))
    assert got == in_order(plain_version(doc_rows))
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


@pytest.mark.parametrize("block", [64, 1000])
def test_texts_longer_than_a_block_are_cut_into_parts(spark, block, monkeypatch):
    monkeypatch.setattr(fim, "BLOCK", block)
    import pyarrow as pa

    rows = [(k, "aé€😀\n" * n) for k, n in enumerate([3, 500, 1, 40, 900, 0, 77])]
    h = [[(k * 7919 + j * 104729) % (1 << 32) for k, _ in rows] for j in range(4)]
    texts = pa.array([t for _, t in rows])
    got = []
    for a, b in fim._slices(texts):
        out = fim.rearranged(texts.slice(a, b - a), [pa.array(x[a:b], pa.int64()) for x in h], fim.SENTINELS, 100, 50)
        got += zip(*[out[c].to_pylist() for c in ("n", "form", "prefix_chars", "middle_chars", "output")], strict=True)
    for (n, form, lo, mid, output), (k, t) in zip(got, rows, strict=True):
        assert n == len(t)
        if form == "plain":
            assert output == t == ""
            continue
        a, b = sorted((h[0][k] % (n + 1), h[1][k] % (n + 1)))
        assert (lo, mid) == (a, b - a)
        parts = {"P": t[:a], "S": t[b:], "M": t[a:b]}
        order = "SPM" if form == "spm" else "PSM"
        assert output == "".join(f"<{c}>{parts[c]}" for c in order)


def test_a_text_of_several_blocks(spark):
    long = "Zeile mit ß und 😀\n" * 120_000
    docs = spark.createDataFrame([(k, long) for k in range(4)] + [(9, "short")], "doc_id bigint, text string")
    got = fim.report(fim.transform(docs)).collect()
    want = {i: hashlib.sha256(o.encode()).hexdigest() for i, _, _, _, _, o in plain_version([(k, long) for k in range(4)] + [(9, "short")])}
    assert {r.doc_id: r.output_sha256 for r in got} == want
    assert {r.restored_sha256 for r in got if r.doc_id < 9} == {hashlib.sha256(long.encode()).hexdigest()}


def test_restored_text_is_exact(spark):
    tails = ["<", "<S", "<P", "x<M", "<<", ">", "S>", ""]
    rows = [(k, f"{a}{b} middle {b}{a}{'é' * (k % 5)}") for k, (a, b) in enumerate((a, b) for a in tails for b in tails)]
    rows += [(500 + k, f"has {s} inside") for k, s in enumerate(fim.SENTINELS)] + [(600, None), (601, ""), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for percent in (0, 100):
        got = fim.transform(docs, fim_percent=100, spm_percent=percent)
        back = {r.doc_id: (r.form, r.back) for r in got.withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()}
        assert {k: t for k, (_, t) in back.items()} == {k: t or "" for k, t in rows}
        assert all(back[500 + k][0] == "plain" for k in range(3))


def test_own_sentinels_and_shares(spark):
    docs = table(spark, SMALL, "documents")
    own = ("[pre]", "{suf}", "|mid>")
    out = fim.transform(docs, sentinels=own, fim_percent=100, spm_percent=100)
    assert {r.form for r in out.select("form").distinct().collect()} == {"spm"}
    back = out.select("doc_id", fim.restore(F.col("output"), F.col("form"), own).alias("text"))
    assert back.exceptAll(docs.select("doc_id", "text")).isEmpty()
    for bad in (("<a>", "<a>", "<b>"), ("<a<", "<b>", "<c>"), ("", "<b>", "<c>")):
        with pytest.raises(ValueError, match="sentinels"):
            fim.transform(docs, sentinels=bad)


def test_empty_table(no_docs):
    out = fim.report(fim.transform(no_docs))
    assert out.count() == 0
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
