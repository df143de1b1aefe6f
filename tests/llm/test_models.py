import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import chat, linkgraph, lm_score, mixing, quality, select
from strata.llm.common import table

from .conftest import rows_of

SMALL, MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# ---- LM scoring

def _brute_scores(rows, good):
    words = [(t or "").lower().split() for _, t in rows]
    n = collections.Counter(w for x in words for w in x)
    known = {w for w, c in n.items() if c >= 2}
    size = len(known) + 1

    def model(places):
        uni, big, ctx = collections.Counter(), collections.Counter(), collections.Counter()
        for p in places:
            before = "<s>"
            for w in words[p]:
                w = w if w in known else None
                uni[w] += 1
                big[before, w] += 1
                before = w
            ctx["<s>"] += 1
        total = sum(uni.values())
        ctx.update(uni)
        return lambda b, w: round(-1000 * math.log((big[b, w] + 50 * (uni[w] + 1) / (total + size)) / (ctx[b] + 50)))

    target, back = model([p for p, r in enumerate(rows) if r[0] in good]), model(range(len(rows)))
    out = []
    for (i, _), x in zip(rows, words, strict=True):
        before, a, b = "<s>", 0, 0
        for w in x:
            w = w if w in known else None
            a, b, before = a + target(before, w), b + back(before, w), w
        out.append((i, len(x), a, b))
    return out


def test_lm_scores_match_brute_force(spark, edge_docs, doc_rows, monkeypatch):
    monkeypatch.setattr(lm_score, "CHUNK_BYTES", 3000)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1, 12)] + [(3, 0, 0), (50, 1, 1), (None, 1, 0), (51, None, 0)], "doc_id bigint, quality int, toxic int")
    good = set(range(1, 12)) - {3}
    got = lm_score.score(edge_docs, labels).collect()
    want = _brute_scores(doc_rows, good)
    key = lambda t: (t[0] is None, t[0] or 0, t[1])
    got = sorted(((r.doc_id, r.n_tokens, r.target_loss, r.background_loss, r.score) for r in got), key=key)
    for g, w in zip(got, sorted(want, key=key), strict=True):
        assert g[:2] == w[:2]
        if not w[1]:
            assert g[2:] == (None, None, None)
        else:
            # A rounding may fall the other way in the last bit of a logarithm.
            assert abs(g[2] - w[2] / w[1] / 1000) < 2e-3 and abs(g[3] - w[3] / w[1] / 1000) < 2e-3
            assert abs(g[4] - (g[2] - g[3])) < 1e-9


def test_lm_scores_prefer_the_target(spark):
    docs, labels = table(spark, MID, "documents"), table(spark, MID, "labels")
    fit_on, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    scored = lm_score.score(docs, fit_on).join(held, "doc_id").toPandas()
    good = scored[(scored.quality == 1) & (scored.toxic == 0)].score
    bad = scored[scored.quality == 0].score
    assert good.median() < bad.median()


def test_lm_scores_empty(spark, no_docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert lm_score.score(no_docs, labels).count() == 0


def test_vocabulary_is_bounded(spark):
    counts = spark.createDataFrame([(i, 1 + i % 50, 0) for i in range(2000)], "word bigint, n bigint, n_target bigint")
    assert len(lm_score.vocabulary(counts, 1, 0, 500).words) <= 500


# ---- mixing

def test_rake_meets_the_margins():
    r = np.random.default_rng(0)
    w, codes = r.random(60) * 1000, np.stack([r.integers(0, k, 60) for k in (5, 3, 4)], axis=1)
    goals = [r.random(k) + 0.2 for k in (5, 3, 4)]
    goals = [g / g.sum() for g in goals]
    f = mixing.rake(w, codes, goals, 2000)
    for k, g in enumerate(goals):
        got = np.bincount(codes[:, k], w * f, len(g))
        assert np.allclose(got / got.sum(), g, atol=1e-6)
    p = mixing.calibrate(w, f, 0.6)
    assert np.isclose((w * p).sum(), 0.6 * w.sum()) and p.max() <= 1 + 1e-12


def test_mixing_report_on_edge_cases(edge_docs):
    rows = mixing.sample_report(edge_docs, share=0.5).collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        assert r.kept == (r.draw < r.probability)
        assert r.lang in ("en", "fr", mixing.NONE)
    kept = mixing.sampled_documents(edge_docs, share=0.5)
    assert kept.columns == edge_docs.columns
    assert kept.count() == sum(r.kept for r in rows)


def test_mixing_given_targets_and_others(edge_docs):
    rows = mixing.sample_report(edge_docs, targets={"lang": {"en": 0.8, "fr": 0.1, mixing.OTHER: 0.1}}).toPandas()
    cells = rows.assign(w=rows.n_tokens * rows.factor)
    assert np.isclose(cells[cells.lang == "en"].w.sum() / cells.w.sum(), 0.8, atol=0.02)


def _mix(spark, rows, targets=None, share=0.5):
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, text string")
    names = {"source": F.col("source"), "lang": F.col("lang"), "topic": F.lit("one")}
    return mixing.Mix(docs, names, F.col("text"), targets, share), docs, names


def _plain_factors(rows, targets, rounds=500):
    """Raking by dictionaries: tokens and factor of each (source, lang)."""
    w = collections.Counter()
    for _, s, lang, t in rows:
        w[s, lang] += len((t or "").split())
    f = dict.fromkeys(w, 1.0)
    for _ in range(rounds):
        for k in (0, 1):
            now = collections.Counter()
            for c in w:
                now[c[k]] += w[c] * f[c]
            goal = targets[k] or {x: sum(n for c, n in w.items() if c[k] == x) ** mixing.TEMPER for x in now}
            there = sum(goal.get(x, 0) for x in now if now[x] > 0)
            for c in w:
                f[c] *= goal.get(c[k], 0) / there * sum(now.values()) / now[c[k]] if now[c[k]] else 1.0
    return w, f


@pytest.mark.parametrize("cells", [0, 10**6])
@pytest.mark.parametrize("given", [False, True])
def test_mixing_matches_brute_force(spark, monkeypatch, cells, given):
    monkeypatch.setattr(mixing, "DRIVER_CELLS", cells)  # 0: as Spark jobs
    r = np.random.default_rng(3)
    rows = [(k, f"s{r.integers(6)}", ["en", "fr", None][r.integers(3)], "w " * int(r.integers(1, 60))) for k in range(150)]
    targets = {"source": {f"s{k}": 1.0 + k for k in range(6)}, "lang": {"en": 0.5, "fr": 0.3, None: 0.2}} if given else {}
    mix, _, _ = _mix(spark, rows, targets, 0.4)
    w, f = _plain_factors(rows, [targets.get("source"), targets.get("lang")])
    got = {(x.source, x.lang): x for x in mix.table.collect()}
    assert set(got) == set(w)
    assert all(math.isclose(got[c].factor, f[c], rel_tol=1e-5) for c in w)
    assert math.isclose(sum(w[c] * got[c].probability for c in w), 0.4 * sum(w.values()), rel_tol=1e-6)
    assert mix.misfit < 1e-4
    reached = {(m.margin, m.category): (m.target, m.reached) for m in mix.margins().collect()}
    assert all(math.isclose(a, b, rel_tol=1e-4) for a, b in reached.values())


@pytest.mark.parametrize("cells", [0, 10**6])
def test_every_source_keeps_its_target(spark, monkeypatch, cells):
    """Eighty sources, each with a target of its own: none loses its documents."""
    monkeypatch.setattr(mixing, "DRIVER_CELLS", cells)
    rows = [(k, f"s{k % 80}", "en", "a b c " * (1 + k % 7)) for k in range(1600)]
    mix, docs, names = _mix(spark, rows, {"source": {f"s{k}": 1.0 + k % 3 for k in range(80)}})
    assert mix.table.where("probability <= 0").isEmpty()
    kept = mixing.sampled_documents(docs, names=names, targets={"source": {f"s{k}": 1.0 for k in range(80)}}, share=0.5)
    assert kept.select("source").distinct().count() == 80


@pytest.mark.parametrize("cells", [0, 10**6])
def test_a_target_of_zero_keeps_nothing(spark, monkeypatch, cells):
    monkeypatch.setattr(mixing, "DRIVER_CELLS", cells)
    rows = [(k, "bad" if k % 2 else "good", "en", "a b c") for k in range(200)]
    rows += [(900, "bad", "en", None), (901, "good", "en", "")]
    for share in (0.3, 0.9):  # 0.9 is out of reach: all good ones are kept
        mix, docs, names = _mix(spark, rows, {"source": {"good": 1.0, "bad": 0.0}}, share)
        p = {x.source: x.probability for x in mix.table.collect()}
        assert p["bad"] == 0.0 and math.isclose(p["good"], min(1.0, 2 * share))
    kept = mixing.sampled_documents(docs, names=names, targets={"source": {"good": 1.0}}, share=0.9)
    assert {x.source for x in kept.collect()} == {"good"} and kept.count() == 101


def test_names_like_the_artificial_ones_stay_apart(spark):
    rows = [(1, None, "en", "a b"), (2, mixing.NONE, "en", "a b"), (3, mixing.OTHER, "en", "a b"), (4, "x", "en", "a b")]
    mix, docs, names = _mix(spark, rows, {"source": {None: 0.4, mixing.NONE: 0.1, "x": 0.3, mixing.OTHER: 0.2}})
    got = {m.category: m.reached for m in mix.margins().where("margin = 'source'").collect()}
    assert {k: round(v, 6) for k, v in got.items()} == {None: 0.4, mixing.NONE: 0.1, mixing.OTHER: 0.2, "x": 0.3}
    assert mixing.sample_report(docs, names=names).count() == 4


def test_targets_that_contradict_are_reported(spark, caplog):
    rows = [(1, "a", "en", "x y"), (2, "b", "fr", "x y")]
    mix, _, _ = _mix(spark, rows, {"source": {"a": 0.9, "b": 0.1}, "lang": {"en": 0.1, "fr": 0.9}})
    assert mix.misfit > 0.5 and "off its target" in caplog.text


def test_mixing_sampled_shares(spark):
    docs = table(spark, MID, "documents")
    rows = mixing.sample_report(docs).toPandas()
    assert abs(rows[rows.kept].n_tokens.sum() / rows.n_tokens.sum() - mixing.SHARE) < 0.05
    weighted = (rows.n_tokens * rows.weight).groupby(rows.lang).sum()
    goal = rows.n_tokens.groupby(rows.lang).sum() ** mixing.TEMPER
    assert np.allclose(weighted / weighted.sum(), goal / goal.sum(), atol=0.05)


def test_mixing_empty(no_docs):
    assert mixing.sample_report(no_docs).count() == 0
    assert mixing.sampled_documents(no_docs).count() == 0


# ---- URL filter

BLOCK, ALLOW = ["net/", "example.com/de/"], ["example.net/en/", "org/fr/"]


def _brute_url(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = rest[:cut], rest[cut:]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    best = None
    for rule in BLOCK + ALLOW:
        h, p = rule.split("/", 1)
        if host and (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best)):
            best = rule
    return host, path, best


def test_url_rules_match_brute_force(spark):
    urls = ["http://A.Example.NET/en/x?y#z", "https://example.net", "http://net/", "http://xnet/a", "foo", None, "", "://", "http://É.org/fr/É?", "a://b://c/d",
            "http://example.com/de/1", "http://example.com/dex", "http://www.example.com/de", "http://q.example.net/en/?a/b", "http://h.org#/fr/", "http://example.net/en/x"]
    pages = spark.createDataFrame([(k if k else None, u, None if k % 2 else "<a href='http://net/'>") for k, u in enumerate(urls)] * 2, "page_id bigint, url string, html string")
    got = linkgraph.judge_pages(pages.selectExpr("*", "1 as host", "2 as rank"), BLOCK, ALLOW).collect()
    assert len(got) == 2 * len(urls)
    for r in got:
        url = urls[r.page_id or 0]
        host, path, rule = _brute_url(url)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        if rule:
            assert r.verdict == ("block" if rule in BLOCK else "allow")


def test_propagation_matches_a_plain_loop(spark):
    r = np.random.default_rng(2)
    hosts = [f"h{k}" for k in range(12)]
    links = sorted({(hosts[a], hosts[b]) for a, b in r.integers(0, 12, (30, 2)) if a != b})
    seeds = {"h1": 10**12, "h2": 5 * 10**11}
    sdf = spark.createDataFrame([("trust", h, s) for h, s in seeds.items()], "kind string, host string, seed bigint")
    ldf = spark.createDataFrame([("trust", a, b) for a, b in links], "kind string, src string, dst string")
    got = {h: v for _, h, v in rows_of(linkgraph.propagate(sdf, ldf))}
    fan = collections.Counter(a for a, _ in links)
    own = {h: s * 15 // 100 for h, s in seeds.items()}
    rank = dict(own)
    for _ in range(linkgraph.ROUNDS):
        now = collections.Counter(own)
        for a, b in links:
            if a in rank:
                now[b] += rank[a] * 85 // (100 * fan[a])
        rank = now
    assert got == dict(rank)


def test_distrust_reaches_hosts_that_link_to_blocked_ones(spark):
    bad = "<a href='http://bad.net/x'>" 
    rows = [(1, "http://bad.net/x", ""), (2, "http://friend.com/a", bad), (3, "http://good.org/fr/a", ""), (4, "http://other.org/en/", "<a href=http://good.org/fr/>")]
    got = {r.page_id: r for r in linkgraph.judge_pages(spark.createDataFrame(rows, "page_id int, url string, html string"), BLOCK, ALLOW).collect()}
    assert got[2].distrust > 0 and got[2].verdict == "block"
    assert got[4].verdict == "allow" and got[3].trust > 0


def _judged(spark, rows):
    pages = spark.createDataFrame(rows, "page_id int, url string, html string")
    return {r.page_id: r for r in linkgraph.judge_pages(pages, BLOCK, ALLOW).collect()}


@pytest.mark.parametrize("crawled", [True, False])
@pytest.mark.parametrize("linkers", [1, 2, 10, 100])
def test_a_link_farm_is_blocked_however_large(spark, linkers, crawled):
    """Hosts that link to a blocked host alone, whether it was crawled or not; and a portal that
    links there too, among many other links."""
    rows = [(k, f"http://farm{k}.com/", "<a href='//bad.net/x'>") for k in range(linkers)]
    rows += [(1000, "http://bad.net/x", "")] if crawled else []
    rows += [(2000, "http://portal.com/", "<a href=http://bad.net/>" + "".join(f"<a href='http://site{k}.com/'>" for k in range(20)))]
    got = _judged(spark, rows)
    assert all(got[k].verdict == "block" and got[k].distrust > 0.1 for k in range(linkers))
    assert got[2000].verdict == "allow" and 0 < got[2000].distrust < 0.01


def test_uncrawled_trusted_hosts_count(spark):
    got = _judged(spark, [(1, "http://good.org/fr/a", "<a href=http://mid.com/>"), (2, "http://mid.com/", "<a href='http://evil.net/'>"), (3, "http://x.com/", "<a href='http://q.org/fr/'>")])
    assert got[2].trust > 0 and got[2].distrust > 0
    assert got[3].distrust == 0  # org/fr/ is no rule for all paths of a host


def test_pages_empty(spark):
    none = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert linkgraph.judge_pages(none, BLOCK, ALLOW).count() == 0


# ---- chat

def _brute_path(hmm, emit):
    value, back = hmm.first + emit[0], []
    for e in emit[1:]:
        came = value[:, None] + hmm.step
        back.append(came.argmax(axis=0))
        value = came.max(axis=0) + e
    return int(value.max())


def _value(hmm, emit, path):
    total = hmm.first[path[0]] + emit[0][path[0]]
    for a, b, e in zip(path, path[1:], emit[1:], strict=False):
        total += hmm.step[a, b] + e[b]
    return int(total)


def test_chat_decodes_the_best_path_across_parts(spark, monkeypatch):
    """One conversation holds most blocks and spans many parts."""
    monkeypatch.setattr(chat, "shuffle_width", lambda s: 6)
    r = np.random.default_rng(6)
    rows = [(7, t, chat.ROLES[1 + t % 2], ["User: hi", "hm?", "A: " + "long " * 60, "plain text", ""][r.integers(0, 5)] + f" {t}") for t in range(300)]
    rows += [(c, t, chat.ROLES[t % 3], f"q: {c} {t}?") for c in (1, 2, 8, 9) for t in range(5)]
    rows += [(None, None, None, None), (3, 0, "robot", "hello"), (3, 0, "robot", "hello"), (9, None, "user", "x")]
    blocks = spark.createDataFrame(rows, "conv bigint, turn bigint, role string, text string")
    got = chat.parse_transcripts(blocks.selectExpr("*", "1 as part", "2 as place")).collect()
    assert len(got) == len(rows)
    parts = chat._parts(blocks)
    assert parts.select("part").distinct().count() > 3
    hmm = chat.fit(parts)
    first, step = np.zeros(3), np.zeros((3, 3))
    convs = collections.defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or 0, x[3] or "")):
        convs[c].append((t, role, text))
    for x in convs.values():
        if x[0][1] in chat.ROLES:
            first[chat.ROLES.index(x[0][1])] += 1
        for (_, a, _), (_, b, _) in zip(x, x[1:], strict=False):
            if a in chat.ROLES and b in chat.ROLES:
                step[chat.ROLES.index(a), chat.ROLES.index(b)] += 1
    plain = chat.Hmm(first, step, [np.zeros((3, f)) for f in chat.FEATURES])
    assert (plain.first == hmm.first).all() and (plain.step == hmm.step).all()
    for c, x in convs.items():
        if c == 3:
            continue
        emit = hmm.emit(np.array([chat.features(text)[0] for _, _, text in x]))
        path = [chat.ROLES.index(g.parsed_role) for g in sorted((g for g in got if g.conv == c), key=lambda g: (g.turn is not None, g.turn or 0))]
        assert _value(hmm, emit, path) == _brute_path(hmm, emit)


def test_chat_accuracy_and_rendering(spark):
    rows = chat.parse_transcripts(chat.as_transcript(table(spark, MID, "conversations"))).collect()
    assert np.mean([r.role == r.parsed_role for r in rows]) > 0.95
    assert all(r.rendered.startswith(f"<|{r.parsed_role}|>\n") and r.rendered.endswith("\n<|end|>") for r in rows)
    assert chat.features("Human - hello?") == ((2, 0, 0, 1), "hello?")
    assert chat.features("Hello: there")[0][0] == 0


def _accuracy(rows, truth):
    return np.mean([r.parsed_role == truth[r.conv, r.turn] for r in rows])


def test_chat_accuracy_on_held_out_and_unknown_roles(spark):
    """Roles known of half the conversations, and of none."""
    blocks = chat.as_transcript(table(spark, MID, "conversations"))
    truth = {(r.conv, r.turn): r.role for r in blocks.collect()}
    half = blocks.withColumn("role", F.when(F.col("conv") % 2 == 0, F.col("role")))
    assert _accuracy([r for r in chat.parse_transcripts(half).collect() if r.conv % 2], truth) > 0.95
    none = blocks.withColumn("role", F.lit(None).cast("string"))
    assert _accuracy(chat.parse_transcripts(none).collect(), truth) > 0.9


def test_chat_clear_markers_need_no_known_role(spark):
    rows = [(c, t, None, f"{'User' if t % 2 == 0 else 'Assistant'}: line {c} {t}") for c in range(2) for t in range(10)]
    blocks = spark.createDataFrame(rows, "conv bigint, turn bigint, role string, text string")
    got = chat.parse_transcripts(blocks).collect()
    assert all(r.parsed_role == ("user" if r.turn % 2 == 0 else "assistant") for r in got) and len(got) == 20


def test_chat_segments_raw_text(spark):
    raw = [(1, "System: be brief\nUser: hello\nsecond line\n\n**Assistant**: hi\nthere: not a marker\n> quoted\nQ - why?\n[Bot]: because"),
           (2, "no marker at all\nbut two lines"), (3, None), (4, ""), (5, "opening words\nHuman: hm"), (6, "user: " + "long " * 50_000)]
    docs = spark.createDataFrame(raw, "conv_id bigint, text string").selectExpr("*", "'x' as turn", "'x' as role")
    cut = chat.segment(docs)
    texts = {}
    for r in cut.orderBy("conv", "turn").collect():
        texts.setdefault(r.conv, []).append(r.text.strip())
    assert texts[1] == ["System: be brief", "User: hello\nsecond line", "**Assistant**: hi\nthere: not a marker\n> quoted", "Q - why?", "[Bot]: because"]
    assert texts[2] == ["no marker at all\nbut two lines"] and texts[3] == texts[4] == [""]
    assert texts[5] == ["opening words", "Human: hm"] and len(texts[6]) == 1
    got = {(r.conv, r.turn): r.parsed_role for r in chat.parse_transcripts(cut).collect()}
    assert [got[1, t] for t in range(5)] == ["system", "user", "assistant", "user", "assistant"]


def test_chat_raw_transcripts_come_back(spark):
    """Conversations of a table as one text each, cut and labelled again without any role."""
    blocks = chat.as_transcript(table(spark, MID, "conversations")).where("text RLIKE '^[A-Z][a-z]*: '")
    whole = blocks.groupBy(F.col("conv").alias("conv_id")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), "\n").alias("text")
    )
    got = chat.parse_transcripts(chat.segment(whole))
    truth = {}
    for r in blocks.orderBy("conv", "turn").collect():
        truth.setdefault(r.conv, []).append(r.role)
    found = {}
    for r in got.orderBy("conv", "turn").collect():
        found.setdefault(r.conv, []).append(r.parsed_role)
    same = [c for c in truth if len(found[c]) == len(truth[c])]
    assert len(same) > 0.9 * len(truth)
    assert np.mean([a == b for c in same for a, b in zip(found[c], truth[c], strict=True)]) > 0.85


def test_chat_empty(spark):
    none = spark.createDataFrame([], "conv bigint, turn bigint, role string, text string")
    assert chat.parse_transcripts(none).count() == 0


# ---- quality

def test_quality_rejects_held_out_bad_documents(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    found = quality.decide(quality.resampler(docs, labels.where("doc_id % 3 <> 0"))).join(labels.where("doc_id % 3 = 0"), "doc_id").toPandas()
    good = (found.quality == 1) & (found.toxic == 0)
    assert found[good].kept.mean() > 0.97
    assert found[~good].kept.mean() < 0.25


def test_quality_matches_brute_force(spark):
    """Counts, ratios, cut, weights, keys and the selection by dictionaries and sorting."""
    from strata.llm.ngrams import HashedNgrams

    r = np.random.default_rng(12)
    plain = [f"w{k}" for k in range(60)]
    rows, marks = [], []
    for k in range(400):
        good = k % 4 != 0
        words = list(r.choice(plain, int(r.integers(5, 40)))) + ([] if good else list(r.choice(["junk!!", "SPAM", "zz9"], 6)))
        r.shuffle(words)
        rows.append((k, " ".join(words)))
        if k < 300:
            marks.append((k, int(good or k % 8 == 0), int(k % 8 == 0)))  # half of the bad ones are toxic, not junk
    rows += [(900, None), (901, ""), (902, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    hashes = docs.selectExpr("doc_id", f"xxhash64(doc_id, {quality.SEED}) AS l", f"xxhash64(doc_id, xxhash64(text), {quality.SEED}) AS h").collect()
    by_label, by_text = {x.doc_id: x.l for x in hashes}, {x.doc_id: x.h for x in hashes}
    known = {i: q == 1 and t == 0 for i, q, t in marks}
    held = {i for i in known if by_label[i] % 100 < quality.HOLD}
    grams = {i: set(HashedNgrams()(t).tolist()) for i, t in rows}
    raw, target = collections.Counter(), collections.Counter()
    inside = [i for i in known if known[i] and i not in held]
    for i, g in grams.items():
        raw.update(g)
        if i in inside:
            target.update(g)
    share = len(inside) / len(rows)
    best = None
    for sigmas in quality.SIGMAS:
        ratio = {b: math.log((target[b] + 1) / (n * share + 1)) for b, n in raw.items() if (target[b] - n * share) / math.sqrt(n * share + 1) <= -sigmas}
        weight = {i: sum(ratio.get(b, 0.0) for b in g) for i, g in grams.items()}
        cut, cost = quality.best_cut(np.array([weight[i] for i in held if known[i]]), np.array([weight[i] for i in held if not known[i]]))
        if best is None or cost < best[0]:
            best = (cost, weight, cut)
    _, weight, cut = best
    key = {}
    for i, w in weight.items():
        u = (((by_text[i] % (1 << 64)) >> 11) + 0.5) / (1 << 53)
        key[i] = max(w * quality.SHARPNESS, -1e6) - math.log(-math.log(u))
    k = sum(w >= cut for w in weight.values())
    kept = set(sorted(key, key=key.get, reverse=True)[:k])
    got = quality.decide(quality.resampler(docs, labels)).collect()
    assert {x.doc_id for x in got if x.kept} == kept
    assert not [(x, weight[x.doc_id]) for x in got if not math.isclose(x.log_weight, weight[x.doc_id], abs_tol=1e-9)]
    assert 0.6 < len(kept) / len(rows) < 0.9


def test_quality_on_edge_cases(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)] + [(65, 0, 0), (66, 0, 0), (67, 0, 1), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    rows = quality.decide(quality.resampler(edge_docs, labels)).collect()
    assert len(rows) == edge_docs.count()
    kept = quality.kept_documents(edge_docs, labels)
    assert kept.columns == edge_docs.columns and kept.count() == sum(r.kept for r in rows)
    none = labels.limit(0)
    assert quality.kept_documents(edge_docs, none).count() == edge_docs.count()
    assert quality.kept_documents(no_docs, labels).count() == 0


@pytest.mark.parametrize("k", [1, 7, 100, 500, 501, 10**6])
def test_kth_largest(spark, k):
    r = np.random.default_rng(1)
    values = [int(v) for v in np.concatenate([r.integers(-(1 << 60), 1 << 60, 250), r.integers(-5, 5, 250)])]
    df = spark.createDataFrame([(v,) for v in values], "v bigint").repartition(3)
    order = sorted(values, reverse=True)
    assert select.kth_largest(df, "v", k) == order[min(k, len(order)) - 1]
    assert select.kth_largest(df.limit(0), "v", k) is None
