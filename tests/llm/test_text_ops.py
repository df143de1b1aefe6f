import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from strata.llm import decontaminate, huffman, simhash
from strata.llm.common import table
from strata.llm.queries import word_vocabulary

from .brute import hits, lower
from .conftest import rows_of

SMALL = "/root/testdata/sf0.001"


def test_decontamination_matches_brute_force(spark, edge_docs, doc_rows):
    long = next(t for i, t in doc_rows if i == 80).split()
    items = [(1, " ".join(long[100:130])), (2, "One, two!"), (3, None), (4, "..."), (None, " ".join(long[500:512])), (5, " ".join(long[100:130]))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = rows_of(decontaminate.report(decontaminate.find_hits(edge_docs, bench)))
    want = hits(doc_rows, items)
    key = lambda t: (t[0] is None, t[0] or 0, t[1:])
    assert sorted(got, key=key) == sorted(want, key=key)
    clean = decontaminate.clean_documents(edge_docs, bench)
    assert clean.columns == edge_docs.columns
    assert clean.count() == sum(not w[5] for w in want)


def test_decontamination_without_broadcast(spark, edge_docs, doc_rows, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    items = [(1, "one two"), (2, next(t for i, t in doc_rows if i == 40))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = rows_of(decontaminate.report(decontaminate.find_hits(edge_docs, bench)))
    key = lambda t: (t[0] is None, t[0] or 0, t[1:])
    assert sorted(got, key=key) == sorted(hits(doc_rows, items), key=key)


def test_decontamination_empty_tables(spark, edge_docs, no_docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.find_hits(no_docs, none).count() == 0
    assert decontaminate.find_hits(edge_docs, none).where("n_hit > 0").count() == 0
    assert decontaminate.find_hits(edge_docs, none).count() == edge_docs.count()


def test_decontamination_plan_is_native(spark):
    plan = decontaminate.find_hits(table(spark, SMALL, "documents"), table(spark, SMALL, "benchmark"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "BroadcastHashJoin" in plan


def test_huffman_code_is_optimal_and_limited():
    counts = {i: 2**i for i in range(20)}
    free = huffman.code_lengths(counts, 20)
    assert sorted(free.values()) == sorted([19, 19, *range(1, 19)])
    short = huffman.code_lengths(counts, 6)
    assert max(short.values()) <= 6 and sum(2.0**-v for v in short.values()) == 1
    assert huffman.code_lengths({7: 3}) == {7: 1}


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 5000])
def test_huffman_round_trip(n):
    r = np.random.default_rng(n)
    ids = np.minimum(r.zipf(1.3, n), 3000).astype(np.uint32)
    counts = dict(zip(*(x.tolist() for x in np.unique(np.append(ids, [1, 2]), return_counts=True)), strict=True))
    code = huffman.Code(huffman.code_lengths(counts))
    bits, marks = code.encode(ids)
    assert (code.decode(bits, marks, n) == ids).all()


def test_token_files_match_the_tokenizer(edge_docs, doc_rows, monkeypatch):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(word_vocabulary())
    got = huffman.digest(huffman.write_and_read(edge_docs, word_vocabulary())).collect()
    assert len(got) == len(doc_rows)
    order = sorted(doc_rows, key=lambda r: (r[0] is not None, r[0] or 0))
    start, want = 0, []
    for i, text in order:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((i, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    begin = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == begin
        begin += r.n_tokens
    assert begin == start
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == [i for i, _ in order]


def test_codes_of_more_than_16_bits():
    r = np.random.default_rng(6)
    ids = np.concatenate([np.arange(70_000), np.minimum(r.zipf(1.2, 50_000), 69_999)]).astype(np.uint32)
    r.shuffle(ids)
    counts = dict(zip(*(x.tolist() for x in np.unique(ids, return_counts=True)), strict=True))
    with pytest.raises(ValueError, match="don't fit"):
        huffman.code_lengths(counts)
    lengths = huffman.code_lengths(counts, 19)
    assert 16 < max(lengths.values()) <= 19
    code = huffman.Code(lengths)
    bits, marks = code.encode(ids)
    assert marks.dtype == np.uint64
    assert (code.decode(bits, marks, len(ids)) == ids).all()


def test_token_files_are_read_by_another_session(spark, scratch):
    rows = [(k, "some words, once more " * k) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    tokens = huffman.tokenise(docs, word_vocabulary())
    counts = {r.id: r.n for r in huffman.count_ids(tokens, word_vocabulary()).collect()}
    to = scratch("files")
    huffman.write_blocks(tokens, word_vocabulary(), huffman.code_lengths(counts), to)
    got = huffman.read_blocks(spark.newSession(), to)
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(word_vocabulary())
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in got.collect()} == {i: [*t.encode(x, add_special_tokens=False).ids, 2] for i, x in rows}


def test_vocabularies_that_keep_spaces_get_whole_texts(edge_docs, doc_rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    assert not huffman.splits_at_space(t) and huffman.splits_at_space(Tokenizer.from_file(word_vocabulary()))
    got = huffman.digest(huffman.write_and_read(edge_docs, path)).collect()
    want = [np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4") for _, x in doc_rows]
    want = [(i, len(ids), zlib.crc32(ids.tobytes())) for (i, _), ids in zip(doc_rows, want, strict=True)]
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)


def test_token_files_empty_table(no_docs):
    assert huffman.write_and_read(no_docs, word_vocabulary()).count() == 0


def _next_and_edit(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    out = []
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        m = len(t) // 3
        out.append((i, t, t[: len(t) - m] + nxt[:m], nxt))
    return out


def _likeness(a, b):
    return 1 - bin(int(a, 16) ^ int(b, 16)).count("1") / 128


def test_simhash_edits_and_likeness(edge_docs, doc_rows):
    rows = [r for r in doc_rows if r[0] is not None]
    docs = edge_docs.where("doc_id IS NOT NULL")
    got = simhash.fingerprint_report(docs).collect()
    want = _next_and_edit(rows)
    edited = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted((i, len(t), edited(e)) for i, t, e, _ in want)
    of = {}
    for r in got:
        of.setdefault((r.doc_id, r.n_chars), r)
    by_text = {}
    for i, t, _, _ in want:
        by_text.setdefault(t, set()).add(of[i, len(t)].fingerprint)
    assert all(len(f) == 1 for f in by_text.values())
    by_text = {t: next(iter(f)) for t, f in by_text.items()}
    assert all(r.near_edited == _likeness(r.fingerprint, r.edited_fingerprint) for r in got)
    near = sorted((i, edited(e), _likeness(by_text[t], by_text[nxt])) for i, t, e, nxt in want)
    assert sorted((r.doc_id, r.edited_sha256, r.near_next) for r in got) == near
    assert of[60, 0].fingerprint == "0" * 32


def test_simhash_null_ids_and_empty(edge_docs, no_docs):
    assert simhash.fingerprint_report(edge_docs).count() == edge_docs.count()
    assert simhash.fingerprint_report(no_docs).count() == 0


def test_simhash_tells_edits_from_other_texts(spark):
    rows = simhash.fingerprint_report(table(spark, SMALL, "documents")).where("n_chars > 300").collect()
    assert np.mean([r.near_edited > r.near_next for r in rows]) > 0.9
    assert np.mean([r.near_edited for r in rows]) - np.mean([r.near_next for r in rows]) > 0.15


@pytest.mark.parametrize("radius", [0, 3, 7])
def test_block_tables_find_all_neighbours(spark, radius):
    r = np.random.default_rng(radius)
    seeds = [int.from_bytes(r.bytes(16), "big") for _ in range(30)]
    fps = set(seeds)
    for s in seeds:
        for _ in range(6):
            x = s
            for b in r.choice(128, r.integers(0, 10), replace=False):
                x ^= 1 << int(b)
            fps.add(x)
    names = [f"{x:032X}" for x in fps]
    df = spark.createDataFrame([(n,) for n in names], "fingerprint string")
    asked = spark.createDataFrame([(n,) for n in names[::3]], "fingerprint string")
    got = rows_of(simhash.neighbours(asked, df, radius))
    want = sorted((a, b) for a in names[::3] for b in names if bin(int(a, 16) ^ int(b, 16)).count("1") <= radius)
    assert sorted(got) == want


def test_radius_finds_near_copies(spark):
    """Copies with a few words replaced, 0.8 similar or more, against brute force."""
    r = random.Random(11)
    texts = sorted({t.text for t in table(spark, SMALL, "documents").collect() if t.text and len(t.text.split()) >= 60})[:120]
    pool = [w for t in texts for w in t.split()]

    def shingles(t):
        w = t.lower().split()
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}

    rows, pairs = [], []
    for i, t in enumerate(texts):
        rows.append((10 * i, t))
        for k, share in enumerate((0.005, 0.01, 0.02)):
            w = t.split()
            for at in r.sample(range(len(w)), max(1, round(share * len(w)))):
                w[at] = r.choice(pool)
            a, b = shingles(t), shingles(" ".join(w))
            rows.append((10 * i + k + 1, " ".join(w)))
            if len(a & b) >= 0.8 * len(a | b):
                pairs.append((10 * i, 10 * i + k + 1))
    fps = simhash.fingerprints(spark.createDataFrame(rows, "id bigint, text string"), ["id"]).localCheckpoint()
    of = {f.id: f.fingerprint for f in fps.collect()}
    asked = fps.where("id % 10 = 0")
    found = set(rows_of(simhash.neighbours(asked, fps)))
    assert len(pairs) > 200
    assert np.mean([(of[a], of[b]) in found for a, b in pairs]) > 0.97
    names = sorted(set(of.values()))
    near = {(of[a], b) for a in of if a % 10 == 0 for b in names if bin(int(of[a], 16) ^ int(b, 16)).count("1") <= simhash.RADIUS}
    assert found == near


@pytest.mark.parametrize("radius", range(32))
def test_blocks_leave_no_pair_out(radius):
    assert sum(flips + 1 for _, _, flips in simhash.blocks(radius)) == radius + 1


def _plain_fingerprint(text):
    """Votes in whole numbers, with Spark's own hashes given."""
    words = [w for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))]
    if text and (all(len(w) < 2 for w in words) or (len(text) > 24 * len(words) and sum(map(len, words)) > 24 * len(words))):
        low = lower(text)
        return [(low[k : k + 3], 1) for k in range(len(low) - 2)] if len(low) >= 3 else [(low, 1)]
    return [(w, (min(len(w), 8) - 1) ** 2) for w in words]


def test_simhash_votes_match_brute_force(spark):
    """Every bit of the fingerprint, from the same term hashes."""
    texts = ["", "a b c d e", "1 2 3 x y z", "one Word two words", "x", "新年快乐大家好" * 9, "A-B-C!", "the the the cat", "word " * 50 + "Ünïcode été", "ab"]
    terms = sorted({t for x in texts for t, _ in _plain_fingerprint(x)})
    rows = spark.createDataFrame([(t,) for t in terms], "t string").selectExpr("t", "xxhash64(t) AS h0", "xxhash64(t, 17) AS h1").collect()
    hashes = {r.t: (r.h0, r.h1) for r in rows}
    docs = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    got = {r.k: r.fingerprint for r in simhash.fingerprints(docs, ["k"]).collect()}
    for k, x in enumerate(texts):
        votes = _plain_fingerprint(x)
        total, bits = sum(w for _, w in votes), 0
        for half in (0, 1):
            for b in range(64):
                if 2 * sum(w for t, w in votes if hashes[t][half] >> b & 1) > total:
                    bits |= 1 << (64 * half + b)
        assert got[k] == f"{bits:032X}", x
    assert [k for k, f in got.items() if f == "0" * 32] == [0]


def test_simhash_of_texts_without_blanks(spark):
    r = random.Random(3)
    signs = [chr(0x4E00 + k) for k in range(600)]
    base = "".join(r.choice(signs) for _ in range(400))
    other = "".join(r.choice(signs) for _ in range(400))
    docs = spark.createDataFrame([(1, base), (2, base + "。"), (3, other)], "doc_id bigint, text string")
    f = {x.doc_id: x.fingerprint for x in simhash.fingerprints(docs, ["doc_id"]).collect()}
    assert _likeness(f[1], f[2]) > 0.95 and _likeness(f[1], f[3]) < 0.7
    long = spark.createDataFrame([(1, "长" * 300_000)], "doc_id bigint, text string")
    assert simhash.fingerprints(long, ["doc_id"]).first().fingerprint != "0" * 32
