"""URL filters, quality, language model, fingerprints, mixing, neighbours, and the pipeline."""

import math
import random
import zlib
from collections import Counter
from functools import reduce
from operator import add

import numpy as np
import pytest
from cases import ROWS, clashing, docs, empty
from pyspark.sql import functions as F

from tidemerge.llm import ann, fingerprints, lm, mixing, quality, urls
from tidemerge.llm.base import ORACLES, QUERIES, small_batches


# ---------------------------------------------------------------- URLs

URLS = [None, "", "no scheme", "http://", "https://EXAMPLE.com", "https://Example.COM/", "https://www.example.com/en/a",
        "https://example.com/EN/", "https://notexample.com/en/", "http://x.net/fr/b?q=/es/", "http://x.net/fr", "http://a.com#/en/",
        "http://ads.one.org/", "http://x.org/banner/", "http://x.org/casino/history/1", "http://x.org/casino/1", "HTTP://X.ORG/A.EXE",
        "ftp://h/mirror/a.exe", "http://x.org/a.exe?b", "http://x.com/a.exe", "http://x.org/\n/banner/\n", "http://u@x.net:80/es/",
        "http://x.org/?utm_medium=spam&a", "http://x.org/?utm_medium=spammer", "http://ü.net/es/", "http://x.org/bads/banners/q/z.gif", *["http://hot.net/es/1"] * 40]


def test_url_rows(spark):
    df = spark.createDataFrame([(i, u, "z", "z", "z") for i, u in enumerate(URLS)], "page_id long, url string, verdict string, host string, rule string")
    got = {r.page_id: r for r in urls.filter_urls(df, urls.RULES).collect()}
    assert len(got) == len(URLS)
    import re
    for i, u in enumerate(URLS):
        u = u or ""
        rest = u.split("://", 1)[1] if "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
        site = [(len(r), r, v) for r, v in urls.SITE_RULES for h, p in [r.split("/", 1)]
                if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        low = "".join(c.lower() if c.isascii() else c for c in u)
        hits = [(r.verdict, r.rule) for r in urls.RULES if not r.site and re.search(r.pattern.replace(r"\z", r"\Z"), low)]
        rule, verdict = (max(site)[1:] if site else (None, min(hits)[0] if hits else "allow"))
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict), u
    assert urls.filter_urls(df.limit(0), urls.RULES).count() == 0


def test_rules_stand_under_their_rarest_token():
    rules = [urls.pattern_rule("/shop/rare/", "block"), urls.pattern_rule("*nothing*", "block")]
    index = urls.index_of(rules, {"shop": 100, "rare": 2})
    assert [t for slot in index for t in slot] in (["rare", ""], ["", "rare"])


# ---------------------------------------------------------------- quality

def test_quality_learns_from_positives_and_unlabelled():
    r = np.random.default_rng(2)
    good, bad = r.normal(0, 1, (3000, 5)), r.normal(2.5, 1, (600, 5))
    model = quality.fit(good[:1000], np.vstack([good[1000:], bad[:500]]), 0.8)
    assert (model.score(good[:500]) >= 0.3).mean() > 0.97 and (model.score(bad[500:]) < 0.3).mean() > 0.9


def test_quality_rows(spark):
    labels = spark.createDataFrame([(1, 1), (6, 1), (9, 0), (9, 1), (None, 1), (7, None), (1, 1)], "doc_id long, quality int")
    d = clashing(spark)
    out = quality.scored(d, quality.train(d, labels), into="s").collect()
    assert len(out) == len(ROWS) and all(0 <= r.s <= 1 for r in out)
    none = quality.train(d, labels.limit(0))
    assert {round(r.s, 6) for r in quality.scored(d, none, into="s").collect()} == {1.0}
    assert quality.scored(empty(spark), none).count() == 0
    assert quality.train(empty(spark), labels).weights.shape


def test_quality_on_held_out_rows(spark, folder):
    rows = {r.doc_id: r for r in QUERIES["op3_quality"](spark, folder).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    known = [(rows[r.doc_id], r.quality) for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if rows[r.doc_id].held_out]
    assert sum(p.predicted == q for p, q in known) / len(known) > 0.9


# ---------------------------------------------------------------- language model

def test_lm_counts_and_base(spark):
    d = docs(spark)
    counts = lm.counted(d.where("doc_id <> 7 or doc_id is null"))
    import re
    words = [re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower()) + [b"\n"] for k, t, *_ in ROWS if k != 7]
    want = Counter(w for x in words for w in x)
    got = {(r.gram, r.h): r.c for r in counts.collect()}
    assert sorted(c for (g, _), c in got.items() if g == 1) == sorted(want.values())
    pairs = Counter(p for x in words for p in zip([b"\n", *x], x))  # noqa: B905
    assert sorted(c for (g, _), c in got.items() if g == 2) == sorted(c for c in pairs.values() if c > 1)
    n, v = sum(want.values()), len(want)
    out = lm.scored(d, counts).collect()
    assert len(out) == len(ROWS)
    for r in out:
        if r.doc_id in (1, 4, 9):
            text = next(t for k, t, *_ in ROWS if k == r.doc_id)
            toks = re.findall(rb"[^\x20\x09-\x0d]+", text.encode().lower()) + [b"\n"]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(toks), sum(want[t] > 0 for t in toks), n)
            assert math.isclose(r.base_score, sum(math.log10((want[t] + 1) / (n + v + 1)) for t in toks))
    assert all(r.score < 0 for r in out)


def test_lm_rare_words_come_from_the_join(spark, monkeypatch):
    d = docs(spark)
    counts = lm.counted(d)
    every = {(r.doc_id, r.n_tokens): (r.n_known, r.base_score) for r in lm.scored(d, counts).collect()}
    monkeypatch.setattr(lm, "EXACT_WORDS", 4)
    some = {(r.doc_id, r.n_tokens): (r.n_known, r.base_score) for r in lm.scored(d, counts).collect()}
    assert every.keys() == some.keys()
    assert all(every[k][0] == some[k][0] and math.isclose(every[k][1], some[k][1]) for k in every)


def test_lm_without_training_rows(spark):
    out = lm.scored(docs(spark), lm.counted(empty(spark))).collect()
    assert len(out) == len(ROWS) and {r.n_known for r in out} == {0} and {round(r.base_score, 9) for r in out} == {0.0}
    assert lm.scored(empty(spark), lm.counted(docs(spark))).count() == 0


def test_filter_never_reads_a_level_too_low(spark):
    r = np.random.default_rng(7)
    h = r.integers(-2**63, 2**63 - 1, 4000, dtype=np.int64)
    c = np.minimum(r.zipf(1.4, 4000), 10_000)
    made = lm.build_filter(spark.createDataFrame([(1, int(a), int(b)) for a, b in zip(h, c, strict=True)], "gram int, h long, c long"))
    got = made.counts(h.view(np.uint64))
    level = lm.level(c)
    floor = np.where(level >= lm.CUT_LEVEL, lm.from_level(level), 0)
    assert (got >= floor).all() and (got > floor).mean() < 0.05
    unseen = made.counts(r.integers(-2**63, 2**63 - 1, 4000, dtype=np.int64).view(np.uint64))
    assert (unseen > 0).mean() < 0.05


# ---------------------------------------------------------------- fingerprints

def test_edited_texts_and_likeness(spark):
    rows = [(i, " ".join(f"t{(i * 37 + j * j) % 300}" for j in range(i % 50)), "en", "s", 1)
            for i in range(200)]
    rows += [(500, None, None, None, None), (501, "", None, None, None), (None, "x y z", None, None, None), (None, "x y z", None, None, None),
             (10, rows[10][1], None, None, None), (900, "日本語 テキスト ü", None, None, None)]
    import hashlib
    out = fingerprints.compare_edits(docs(spark, rows)).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = Counter()
    for i, r in enumerate(order):
        t, after = r[1] or "", order[(i + 1) % len(order)][1] or ""
        m = len(t) // 3
        want[(r[0], len(t), hashlib.sha256((t[:len(t) - m] + after[:m]).encode()).hexdigest())] += 1
    # rows without an id follow one another by a hash of the text: compare those with an id
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in out if r.doc_id not in (None, 0)) == Counter(
        {k: n for k, n in want.items() if k[0] not in (None, 0)})
    assert len(out) == len(rows) and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    prints = {}
    for r in out:
        prints.setdefault(r.n_chars if r.doc_id in (10, 500, 501) else r.doc_id, set()).add(r.fingerprint)
    assert len({r.fingerprint for r in out if r.doc_id == 10}) == 1 and len({r.fingerprint for r in out if r.doc_id in (500, 501)}) == 1


def test_fingerprints_of_few_rows(spark):
    one = fingerprints.compare_edits(docs(spark, [(5, "abcdef", "en", "s", 6)])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert fingerprints.compare_edits(empty(spark)).count() == 0
    assert fingerprints.compare_edits(clashing(spark)).count() == len(ROWS)


def test_groups_follow_the_ids(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "GROUP_ROWS", 5)
    rows = [(i * i, f"text {i}", "en", "s", 1) for i in range(60)]
    got = fingerprints.grouped(docs(spark, rows).select("doc_id", "text"), "doc_id").orderBy("doc_id").collect()
    groups = [r._group for r in got]
    assert groups == sorted(groups) and len(set(groups)) >= 8


# ---------------------------------------------------------------- mixing

def test_targets():
    assert mixing.targets([100, 100, 100]) == [200, 500 / 3, 250 / 3]
    assert mixing.targets([10, 0, 1000]) == [20, 0, 1495]
    assert mixing.targets([]) == []


def test_mix_rows(spark):
    r = random.Random(8)
    rows = [(i, "w " * r.randint(0, 400), "en", r.choice(["a", "a", "a", "b", None]), 1) for i in range(400)] + ROWS
    d = docs(spark, rows)
    out = mixing.mix_counts(d).collect()
    again = mixing.mix_counts(d.repartition(5)).collect()
    assert Counter(map(tuple, out)) == Counter(map(tuple, again)) and len(out) == len(rows)
    assert all(0 <= x.taken <= 2 * x.size for x in out)
    by_source = {}
    for x in out:
        s = by_source.setdefault((x.source_size, x.target), [0, 0])
        s[0] += x.size
        s[1] += x.taken
    for (size, target), (total, taken) in by_source.items():
        assert size == total and abs(taken - target) <= max(2, 0.1 * target)
    mixed = mixing.mix(d)
    assert mixed.columns == d.columns
    words = mixed.select(F.sum(mixing.n_words(F.col("text")))).first()[0]
    assert words == sum(x.taken for x in out)
    assert mixing.mix_counts(empty(spark)).count() == 0 == mixing.mix(empty(spark)).count()
    wide = clashing(spark).withColumns({c: F.lit(1) for c in ("round", "slot", "first", "last", "block")})
    assert set(mixing.mix(wide).columns) == set(wide.columns) and mixing.mix(wide).count() > 0


def test_block_sizes():
    def of(*targets):
        return mixing.block_sizes([mixing.Share(i, str(i), 1, 1, t) for i, t in enumerate(targets)])

    assert of(1e6, 2e6) == [128, 128] and of(1e6, 640) == [128, 10] and of(5, 0) == [1, 1] and of() == []
    assert of(1e13, 640, 10) == [math.ceil((1e13 + 650) / mixing.MOST_SLOTS), 10, 1]


def test_tiny_sources_beside_a_large_one_come_near_their_targets(spark, monkeypatch):
    """As if the mix were so large that a common block would be longer than the small sources."""
    monkeypatch.setattr(mixing, "MOST_SLOTS", 200)
    text = lambda n: " ".join(["w"] * n)
    rows = [(i, text(500), "en", "a", 0) for i in range(200)] + [(1000 + i, text(5), "en", "b", 0) for i in range(2)] \
        + [(2000 + i, text(30), "en", "c", 0) for i in range(10)]
    got = mixing.mix_counts(docs(spark, rows)).collect()
    for source, first in (("b", 1000), ("c", 2000)):
        mine = [r for r in got if first <= r.doc_id < first + 1000]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(2, 0.05 * mine[0].target), source
        assert all(r.taken <= 2 * r["size"] for r in mine)


def test_ranks_of_slots_run_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLOT_CHUNK", 64)
    mixture = [mixing.Share(0, "a", 1, 5000, 3000.0), mixing.Share(1, "b", 1, 5000, 1000.0)]
    rows = sorted(mixing.slots(spark, mixture, [10, 10]).collect(), key=lambda r: r.slot)
    assert [r.slot for r in rows] == list(range(400))
    for place, share in ((0, 0.75), (1, 0.25)):
        mine = [r for r in rows if r._place == place]
        assert [r["rank"] for r in mine] == list(range(len(mine)))
        for n in (20, 100, 399):
            assert abs(sum(r.slot <= n for r in mine) - share * (n + 1)) < 4


# ---------------------------------------------------------------- neighbours

def test_nearest_rows(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 150)
    monkeypatch.setattr(ann, "QUERY_ROWS", 7)
    r = np.random.default_rng(4)
    vectors = [(i, [float(x) for x in v]) for i, v in enumerate(r.normal(0, 1, (600, 6)).astype(np.float32) * r.uniform(.2, 3, (600, 1)).astype(np.float32))]
    vectors += [(600 + i, vectors[0][1]) for i in range(90)]  # one vector many times
    vectors += [(1000, None), (1020, [0.0] * 6), (1040, [1.0, None, 0.0]), (1060, [float("nan")] + [1.0] * 5), (1080, [float("inf")] * 6), (1100, []),
                (None, [1.0] * 6), vectors[20]]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    got = {}
    for x in ann.nearest(df, df.where("vec_id % 20 = 0")).collect():
        got.setdefault(x.query_id, []).append((x["rank"], x.vec_id, x.score))
    good = {i: np.array(v, np.float64) for i, v in vectors if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    for q in [i for i in good if i % 20 == 0]:
        scores = sorted((-reduce(add, (good[q] * v).tolist(), 0.0), i) for i, v in good.items() if i != q)[:20]
        assert [(k, i) for k, i, _ in sorted(got[q])] == [(n + 1, i) for n, (_, i) in enumerate(scores)]
        assert [s for *_, s in sorted(got[q])] == [-s for s, _ in scores]
    assert set(got) == {i for i in good if i % 20 == 0}
    assert ann.nearest(df.limit(0), df).count() == 0 == ann.nearest(df, df.limit(0)).count()


def test_relaxed_trees_skip_and_still_find():
    r = np.random.default_rng(6)
    points = r.normal(0, 1, (3000, 3))
    tree = ann.Tree(points)
    queries = r.normal(0, 1, (40, 3))
    exact = np.argsort(((queries[:, None] - points) ** 2).sum(axis=2), axis=1)[:, :10]
    full, _ = tree.search(queries, 10)
    assert [set(a) for a in full] == [set(a) for a in exact]
    rough, _ = tree.search(queries, 10, 0.3)
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(rough, exact, strict=True)]) > 0.5


# ---------------------------------------------------------------- queries and pipeline

@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, folder, name):
    from oracle import _canonical, connect
    df = QUERIES[name](spark, folder)
    cur = connect(folder).execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert _canonical(df.columns, [tuple(r) for r in df.collect()]) == _canonical(columns, cur.fetchall())


def test_small_batches_keep_a_setting_of_the_session(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "77")
    small_batches(lambda s: None)(spark)
    assert spark.conf.get(key) == "77"
    spark.conf.set(key, before)


def test_pipeline(spark, folder):
    import corpus_pipeline as C
    from test_near import linked, smallest_of
    from test_texts import plain_removal
    original = spark.read.parquet(f"{folder}/documents.parquet")
    steps, d = [], original
    for name, stage in C.STAGES:
        d = C.stored(stage(spark, d, folder), name)
        steps.append(d)
        assert name == "tokens" or d.columns == original.columns
    good, one, cut, mixed, tokens = steps
    scores = quality.scored(original, quality.train(original, spark.read.parquet(f"{folder}/labels.parquet")), into="s")
    assert {r.doc_id for r in scores.where("s >= 0.3").collect()} == {r.doc_id for r in good.collect()}
    rows = sorted((r.doc_id, r.text) for r in good.collect())  # few rows: every pair by its shingles
    low = smallest_of(len(rows), linked([text for _, text in rows]))
    left = [rows[i][0] for i, least in enumerate(low) if least == i]
    assert sorted(r.doc_id for r in one.collect()) == left
    before = sorted(one.collect(), key=lambda r: r.doc_id)
    after = {r.doc_id: r.text for r in cut.collect()}
    for r, (n, gone, spans, _) in zip(before, plain_removal([r.text for r in before]), strict=True):
        assert n - gone <= len(after[r.doc_id].encode()) <= n - gone + 4 * spans
    sizes = {r.doc_id: len(r.text.encode().split()) for r in cut.collect()}
    taken = Counter()
    for r in mixed.collect():
        taken[r.doc_id] += len(r.text.encode().split())
        assert after[r.doc_id].startswith(r.text)
    assert all(taken[i] <= 2 * sizes[i] for i in taken) and abs(sum(taken.values()) - 1.5 * sum(sizes.values())) < 0.05 * sum(sizes.values())
    assert tokens.count() == mixed.count() and {"doc_id", "token_ids", "n_tokens"} <= set(tokens.columns)


def test_thin_labels_still_give_positives_and_null_ids_are_bounded(spark):
    """40 labelled documents among many without a label or an id: positives come from all labelled ones."""
    from pyspark.sql import functions as F
    good = [(i, "A plain sentence of words, well formed and calm. " * 8 + str(i)) for i in range(40)]
    bad = [(1000 + i, "$$$ ### " * 60 + str(i)) for i in range(400)] + [(None, "| x | y " * 50)] * 800
    d = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(1000 + i, 0) for i in range(360)], "doc_id long, quality int")
    assert quality._chosen(d, 1.0).count() == 441
    model = quality.train(d, labels, sample_rows=200)
    rows = quality.scored(d.where("doc_id is not null"), model).select("doc_id", "score").collect()
    assert min(r.score for r in rows if r.doc_id < 1000) > max(r.score for r in rows if r.doc_id >= 1000)
    assert 0 <= quality.scored(d.limit(3), quality.train(d, labels.where(F.lit(False)))).first().score <= 1
