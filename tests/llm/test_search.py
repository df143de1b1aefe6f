import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import ranked_search
from strata.llm.common import table

from .brute import lower

SMALL = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_version(docs, items, k=10):
    """(item, rank, score) and the (score, id) rows found: equal rows have no order."""
    texts = [(i, collections.Counter(TERM.findall(lower(t)))) for i, t in docs]
    lengths = [sum(c.values()) for _, c in texts]
    big_n, big_l = sum(n > 0 for n in lengths), sum(lengths)
    df = collections.Counter(t for _, c in texts for t in c)
    wanted = collections.defaultdict(set)
    for item, t in items:
        wanted[item] |= set(TERM.findall(lower(t)))
    out = []
    for item, ts in wanted.items():
        found = []
        for (i, c), n in zip(texts, lengths, strict=True):
            score = 0
            for t in ts & set(c):
                w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                m = 100 - 90 + (90 * n * big_n) // big_l
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(found)[:k])]
    return out


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


@pytest.fixture(scope="module")
def item_rows(doc_rows):
    texts = [t for _, t in doc_rows if t]
    rows = [(k, " ".join(t.split()[:30])) for k, t in enumerate(texts)]
    return rows + [(200, None), (201, ""), (202, "nowhere-to-be-found"), (None, texts[0]), (203, "the of and"), (203, texts[3][:50]), (204, "THE the")]


def frames(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    q = spark.createDataFrame(items, "item_id bigint, text string").repartition(2)
    names = ("term", "shard", "block", "w", "items", "df", "rank", "score")
    return [x.withColumns({c: F.lit("extra") for c in names}) for x in (d, q)]


@pytest.mark.parametrize("shard_bytes, per_block", [(16 << 20, 256), (3000, 7), (1, 1)])
def test_search_matches_brute_force_on_edge_cases(spark, doc_rows, item_rows, monkeypatch, shard_bytes, per_block):
    monkeypatch.setattr(ranked_search, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(ranked_search, "ITEMS_PER_BLOCK", per_block)
    docs, items = frames(spark, doc_rows, item_rows)
    got = ranked_search.search(ranked_search.build_index(docs), items)
    assert in_order(got.collect()) == in_order(plain_version(doc_rows, item_rows))


def test_other_k_and_string_ids(spark, doc_rows):
    items = [("a", "the of abcde"), ("b", doc_rows[3][1]), ("a", doc_rows[5][1])]
    docs, _ = frames(spark, doc_rows, [(1, "x")])
    q = spark.createDataFrame(items, "name string, body string")
    got = ranked_search.search(ranked_search.build_index(docs), q, k=3, item_col="name", text_col="body")
    assert sorted(tuple(r) for r in got.collect()) == sorted(plain_version(doc_rows, items, 3))


def test_search_matches_brute_force_on_documents(spark):
    docs, items = table(spark, SMALL, "documents"), table(spark, SMALL, "benchmark")
    rows = [[tuple(r) for r in x.collect()] for x in (docs.select("doc_id", "text"), items.select("item_id", "text"))]
    got = ranked_search.search(ranked_search.build_index(docs), items)
    assert in_order(got.collect()) == in_order(plain_version(*rows))


def test_variable_bytes_round_trip():
    r = np.random.default_rng(0)
    for high in (2, 128, 300, 1 << 14, 1 << 31):
        values = r.integers(0, high, 5000)
        raw, begin = ranked_search.encode(values)
        assert (ranked_search.decode(raw) == values).all()
        assert (ranked_search.decode(raw[begin[777] :]) == values[777:]).all()


def _shard(seed, n_docs, vocabulary):
    """Lists of a random shard, as the search reads them, and plain term counts."""
    r = random.Random(seed)
    texts = [collections.Counter(int(vocabulary * r.random() ** 3) for _ in range(r.randint(1, 40))) for _ in range(n_docs)]
    m = np.array([10 + 3 * sum(c.values()) for c in texts], np.int64)
    posts = sorted((t, d, tf) for d, c in enumerate(texts) for t, tf in c.items())
    number, doc, tf = (np.array(x, np.int64) for x in zip(*posts, strict=True))
    held = np.unique(number)
    batch = ranked_search._lists(0, [b"%d" % t for t in held], np.searchsorted(held, number), doc, tf, m)
    return {int(x["term"]): x for x in batch.to_pylist()}, texts, m


@pytest.mark.parametrize("seed", range(6))
def test_best_of_a_shard_and_blocks_left_unread(seed):
    rows, texts, m = _shard(seed, 20_000, 300)
    r = random.Random(seed)
    rank = np.array(r.sample(range(len(texts)), len(texts)))
    left = total = 0
    for _ in range(12):
        query = [(r.choice((0, 5, 60, 900, 4000)), t) for t in r.sample(sorted(rows), 8)]
        lists = [(w, ranked_search.Postings(rows[t], m)) for w, t in query]
        top, scores = ranked_search.best(lists, rank, 10)
        want = []
        for d, c in enumerate(texts):
            s = sum(w * (10**9 * c[t] // (1000 * c[t] + 8 * int(m[d]))) for w, t in query if c[t])
            if s:
                want.append((-s, rank[d], d))
        want = sorted(want)[:10]
        assert [(-s, d) for s, d in zip(scores, top, strict=True)] == [(s, d) for s, _, d in want]
        left += sum(int((~p.read).sum()) for _, p in lists)
        total += sum(len(p.read) for _, p in lists)
    assert left > 0.05 * total


def test_length_class_beyond_64_bits():
    n = np.array([1, 7, 10**6], np.int64)
    assert list(ranked_search.length_class(n, 10**13, 10**17)) == [10 + 90 * int(x) * 10**13 // 10**17 for x in n]


def test_empty_tables(spark, no_docs, item_rows):
    _, items = frames(spark, [(1, "x")], item_rows)
    assert ranked_search.search(ranked_search.build_index(no_docs), items).count() == 0
    docs = table(spark, SMALL, "documents")
    out = ranked_search.search(ranked_search.build_index(docs), items.limit(0))
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    assert out.count() == 0
