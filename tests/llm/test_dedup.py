import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import components, minhash, suffix_dedup
from strata.llm.common import table

from .brute import near_dups, repeats
from .conftest import rows_of

SMALL = "/root/testdata/sf0.001"


def test_minhash_matches_brute_force_on_edge_cases(edge_docs, doc_rows):
    got = rows_of(minhash.report(minhash.near_duplicates(edge_docs)))
    want = sorted(near_dups(doc_rows), key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))
    assert got == want


def test_minhash_matches_brute_force_on_documents(spark):
    docs = table(spark, SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(rows_of(minhash.report(minhash.near_duplicates(docs)))) == sorted(near_dups(rows))


def test_minhash_empty_table(no_docs):
    assert minhash.near_duplicates(no_docs).count() == 0
    assert minhash.first_of_each(no_docs).columns == no_docs.columns


def test_first_of_each_keeps_columns(edge_docs, doc_rows):
    kept = minhash.first_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted(r.doc_id for r in kept.where("doc_id between 40 and 45").collect())
    assert ids == [i for i, _, _, k in sorted(near_dups(doc_rows[:40])) if k and 40 <= i <= 45]
    # Of three rows with id 70 two repeat document 40, the third is a text of its own.
    assert kept.where("doc_id = 70").count() == 1


def test_one_row_of_each_component_stays(spark):
    """Redelivered rows, copies without ids, and one id with several near texts."""
    base, other, third = (" ".join(f"{c}{k}" for k in range(100)) for c in "abc")
    rows = [(5, base, "x"), (5, base, "y"), (5, base, "x"), (9, base, "z"), (5, base + " end", "x"), (5, third, "x")]
    rows += [(None, other, "x"), (None, other, "x"), (None, other, "y"), (None, other + " end", "x")]
    rows += [(None, None, "x"), (None, None, "x"), (7, "", "x"), (7, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    kept = minhash.first_of_each(docs.withColumns({c: F.lit("extra") for c in ("row", "place", "salt", "d", "r", "n", "first", "rep_id")}))
    left = kept.select("doc_id", "text", "source").collect()
    full = [r for r in left if r.text]
    assert sorted((r.doc_id is None, r.text.split()[0]) for r in full) == [(False, "a0"), (False, "c0"), (True, "b0")]
    assert {tuple(r) for r in full} <= set(rows)
    assert len(left) - len(full) == 4


def test_classes_beyond_the_leader_are_found(spark):
    """A chain: neighbours are similar, ends are not; the bucket's leader knows few of them."""
    r = random.Random(3)
    w = [f"w{r.randrange(10**6)}" for _ in range(400)]
    rows = [(100 - k, " ".join(w[k * 4 : k * 4 + 200])) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = rows_of(minhash.report(minhash.near_duplicates(docs)))
    assert sorted(got) == sorted(near_dups(rows))
    assert {g[2] for g in got} == {71}


def test_estimate_is_corrected_for_chance(spark):
    r = np.random.default_rng(1)
    a = r.integers(0, 2**63, 2000).astype(np.uint64)
    for share in (0.0, 0.5, 0.85, 1.0):
        keep = int(2000 * 2 * share / (1 + share))
        b = np.concatenate([a[:keep], r.integers(0, 2**63, 2000 - keep).astype(np.uint64)])
        _, s = minhash.sketch([np.unique(a), np.unique(b)])
        df = spark.createDataFrame([(s[0].tolist(), s[1].tolist())], "x array<bigint>, y array<bigint>")
        assert abs(df.select(minhash.estimate("x", "y")).first()[0] - share) < 0.14


@pytest.mark.parametrize("seed", [0, 1])
def test_components_match_union_find(spark, seed):
    r = random.Random(seed)
    links = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(200, 200 + k) for k in range(1, 40)] + [(300 + k, 301 + k) for k in range(20)]
    parent = {x: x for ab in links for x in ab}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {n: root for n, root in rows_of(components.connected_components(spark.createDataFrame(links, "a bigint, b bigint")))}
    assert got == {x: find(x) for x in parent if find(x) != x}


def _ordered(df, packed):
    """Rows in the order that the chunks fix: id (null first), chunk, place."""
    rows = packed.select("chunk", "doc_ids").orderBy("chunk").collect()
    return [(i, (r.chunk, k)) for r in rows for k, i in enumerate(r.doc_ids)]


@pytest.mark.parametrize("chunk_bytes", [900, 2 << 20])
def test_suffix_dedup_matches_brute_force(edge_docs, chunk_bytes, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", chunk_bytes)
    packed = suffix_dedup.chunks(edge_docs, "doc_id", "text", chunk_bytes)
    texts = []
    for row in packed.orderBy("chunk").collect():
        c = suffix_dedup.Chunk(row.asDict())
        texts += [(c.doc_ids[k], c.raw[c.begins[k] : c.ends[k]].tobytes().decode()) for k in range(len(c.sizes))]
    # Ties among equal ids follow chunks, so they are compared as a whole only.
    order = sorted(texts, key=lambda t: -(1 << 63) if t[0] is None else t[0])
    want = repeats(order)
    got = rows_of(suffix_dedup.report(suffix_dedup.remove_repeats(edge_docs)))
    unique = {i for i, _ in texts if [x for x, _ in texts].count(i) == 1}
    assert sorted(g for g in got if g[0] in unique) == sorted(w for w in want if w[0] in unique)
    assert sum(g[2] for g in got) == sum(w[2] for w in want)


def test_suffix_dedup_empty_table(no_docs):
    assert suffix_dedup.remove_repeats(no_docs).count() == 0


def test_loser_tree_merges_and_knows_prefixes():
    r = np.random.default_rng(4)
    rows = np.zeros((300, suffix_dedup.WIDTH), np.uint8)
    rows[:, :12] = r.integers(97, 99, (300, 12))
    runs, every = [], []
    for part in np.array_split(rows, 7):
        part = np.unique(part, axis=0)
        strings = [x.tobytes() for x in part]
        runs.append((strings, suffix_dedup._lcps(part).tolist()))
        every += strings
    runs.append(([], []))
    order, lcps = suffix_dedup.merge_runs(runs)
    merged = [runs[a][0][b] for a, b in order]
    assert merged == sorted(every)
    assert lcps == suffix_dedup._lcps(np.frombuffer(b"".join(merged), np.uint8).reshape(-1, suffix_dedup.WIDTH)).tolist()


def test_front_coding_round_trip():
    r = np.random.default_rng(9)
    rows = np.unique(r.integers(0, 2, (50, suffix_dedup.WIDTH)).astype(np.uint8), axis=0)
    lcps = suffix_dedup._lcps(rows)
    tails = rows[np.arange(suffix_dedup.WIDTH) >= lcps[:, None]].tobytes()
    assert (suffix_dedup._unfold(len(rows), lcps, tails) == rows).all()


def _in_rows(rows, spark):
    got = suffix_dedup.report(suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)))
    return rows_of(got)


def _wanted(rows):
    return sorted(repeats(sorted(rows, key=lambda r: r[0])))


@pytest.mark.parametrize("hot, slice_, range_bytes", [(2, 1 << 16, 4 << 20), (20_000, 50, 4 << 20), (5, 7, 500)])
def test_hot_grams_slices_and_ranges_change_nothing(spark, monkeypatch, hot, slice_, range_bytes):
    for name, value in (("HOT", hot), ("SLICE", slice_), ("RANGE_BYTES", range_bytes), ("CHUNK_BYTES", 3000)):
        monkeypatch.setattr(suffix_dedup, name, value)
    r = random.Random(hot)

    def word():
        return "".join(r.choice("abcdeé") for _ in range(r.randint(2, 9)))

    phrase = " ".join(word() for _ in range(14))[:60]
    passage = " ".join(word() for _ in range(60))
    rows = [(k, f"{' '.join(word() for _ in range(r.randint(5, 40)))} {phrase} {' '.join(word() for _ in range(r.randint(5, 40)))}") for k in range(120)]
    rows += [(200 + k, f"{word()} {passage} {word()} {phrase}{'x' * k}") for k in range(40)]
    rows += [(300, "ab" * 400), (301, " " * 700), (302, "x" + " " * 300 + "y"), (303, phrase * 9)]
    assert _in_rows(rows, spark) == _wanted(rows)


def test_a_long_uniform_text(spark):
    """Two million blanks, twice: all but the first window of the first text repeat."""
    n = 2_000_000
    rows = [(1, " " * n), (2, "start " + " " * n), (3, "ab" * 100_000)]
    got = {r[0]: r[1:4] for r in _in_rows(rows, spark)}
    assert got[1] == (n, n - 1, 1)  # every window after the first covers all but the first byte
    assert got[2] == (n + 6, n + 1, 1)  # with the blank before them
    assert got[3] == (200_000, 200_000 - 2, 1)


def test_a_phrase_in_many_surroundings(spark):
    """Shorter than a window: nothing repeats, although every document has it."""
    r = random.Random(8)
    phrase = "all rights reserved, no part may be reproduced without leave"
    rows = [(k, f"{r.getrandbits(300):x} {phrase} {r.getrandbits(300):x}") for k in range(30_000)]
    rows += [(50_000, rows[77][1]), (50_001, "x" + rows[78][1])]
    got = {r[0]: r[2] for r in _in_rows(rows, spark)}
    n = len(rows[77][1])
    assert got[50_000] == n and got[50_001] == len(rows[78][1])
    assert sum(got.values()) == n + len(rows[78][1])


def test_left_context_is_compared_by_bytes(monkeypatch):
    """A rolling hash that takes all left contexts for equal removes nothing."""
    monkeypatch.setattr(suffix_dedup, "_M", np.uint64(0))
    r = np.random.default_rng(2)
    rows = r.integers(97, 123, (40, suffix_dedup.WIDTH)).astype(np.uint8)
    rows[:, : suffix_dedup.RIGHT] = rows[0, : suffix_dedup.RIGHT]
    rows = np.unique(rows, axis=0)
    meta = np.zeros(len(rows), suffix_dedup.META)
    meta["at"], meta["lo"], meta["hi"] = np.arange(len(rows)) * 1000, 0, suffix_dedup.SPAN - 1
    again = suffix_dedup._repeats(rows, suffix_dedup._lcps(rows).astype(np.int64), meta, np.zeros(len(rows), np.int64))
    assert again[:, 0].sum() == len(rows) - 1 and not again[:, 30:].any()
