"""License scans, BPE, SimHash, suffix dedup: each against a plain version."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import tiktoken
import xxhash
from cases import ROWS, clashing, docs, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemerge.llm import bpe, license_scan, simhash, suffixes


# ---------------------------------------------------------------- licenses

def test_templates_accept_optional_and_replaceable_regions():
    a = license_scan.compiled("see [[the]] file {{1-2}} for [[all [[the]]]] terms", "x")
    for text, want in [("see file a for terms", 5), ("see the file a b for all the terms", 9), ("see the file for terms", None),
                       ("see file a b c for terms", None), ("see file a for all terms", 6)]:
        assert a.accepts([w.encode() for w in text.split()], 0) == want, text
    with pytest.raises(ValueError):
        license_scan.compiled("{{1-2}} first", "x")
    with pytest.raises(ValueError):
        license_scan.compiled("open [[ region", "x")


def test_license_places_and_labels():
    found = license_scan.scan("Released under the MIT-License!\nThe (Apache) license; general  public LICENSE. mit license")
    assert found.places == [(3, "mit"), (11, "mit"), (6, "apache"), (8, "gpl")]
    assert {m[2] for m in found.matches} == {"mit-notice"} and found.score == 1.0
    assert license_scan.scan("mit  llicense, mit. Xlicense").places == []
    assert license_scan.scan(None).n_words == 0
    text = "this great work is licensed under the gnu general public license, version 3"
    assert license_scan.scan(text).matches == [(0, 13, "gpl-notice")]
    assert license_scan.scan(text.replace("gnu ", "")).matches == []


def test_license_words_are_those_of_the_pattern():
    for _, text, *_ in ROWS:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        assert license_scan.scan(text).n_words == len(re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered))


def test_license_rows(spark):
    out = license_scan.scan_documents(clashing(spark)).collect()
    assert len(out) == len(ROWS) and {r.base_labels for r in out} == {""}
    assert license_scan.scan_documents(empty(spark)).count() == 0


# ---------------------------------------------------------------- BPE

@pytest.fixture(scope="module")
def reference():
    import public_tokenizers
    ranks = bpe.read_ranks(bpe.vocabulary_path())
    return ranks, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_split_and_merge_as_the_library(text):
    import public_tokenizers
    ranks = _ranks()
    enc = _encoding(public_tokenizers.PATTERN)
    assert [i for w in bpe.split(text) for i in bpe.merge(w.encode(), ranks)] == enc.encode_ordinary(text)


_cache = {}


def _ranks():
    return _cache.setdefault("r", bpe.read_ranks(bpe.vocabulary_path()))


def _encoding(pattern):
    return _cache.setdefault("e", tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=_ranks(), special_tokens={}))


def test_long_words_are_merged_alike(reference):
    ranks, enc = reference
    r = random.Random(5)
    for n in (97, 150, 1000):
        word = "".join(r.choice("abcdeinrst") for _ in range(n)).encode()
        assert bpe._merge_long(word, ranks) == enc._encode_single_piece(word)
    assert len(bpe.merge(b"a" * 100_000, ranks)) > 1


def test_bpe_rows(spark, reference):
    _, enc = reference
    path = bpe.vocabulary_path()
    out = bpe.digests(bpe.encode(clashing(spark), path, keep=["doc_id", "text"], decoded="decoded")).collect()
    want = Counter()
    for key, text, *_ in ROWS:
        ids = enc.encode_ordinary(text or "")
        want[(key, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
              hashlib.sha256((text or "").encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out) == want
    assert bpe.encode(empty(spark), path).count() == 0


def test_fold_in_spark_equals_the_merge(spark, reference):
    ranks, _ = reference
    words = [" the", "naïve", "xqzzj", " 12345", "\n\n", "a", "ßträ", "thththth"]
    got = spark.createDataFrame([(w,) for w in words], "word string").select(
        "word", bpe.folded(F.col("word"), bpe.rank_map(ranks)).alias("ids")).collect()
    assert {r.word: r.ids for r in got} == {w: bpe.merge(w.encode(), ranks) for w in words}


def test_plans_of_an_encoding_stay_short(spark, reference, monkeypatch):
    ranks, _ = reference
    rows = docs(spark)
    plans, plain, key = [], type(rows).toArrow, "spark.sql.maxPlanStringLength"

    def noted(df):
        before = spark.conf.get(key)
        spark.conf.set(key, str(1 << 30))
        plans.append(len(df._jdf.queryExecution().optimizedPlan().toString()))
        spark.conf.set(key, before)
        return plain(df)

    monkeypatch.setattr(type(rows), "toArrow", noted)
    out = bpe.encode(rows, bpe.vocabulary_path()).collect()
    assert plans and max(plans) < 20_000
    for r in out:
        assert r.ids == [i for w in bpe.split(r.text or "") for i in bpe.merge(w.encode(), ranks)]


def test_words_beyond_the_broadcast_table(spark, reference, monkeypatch):
    monkeypatch.setattr(bpe, "VOCABULARY", 3)
    _, enc = reference
    path = bpe.vocabulary_path()
    out = bpe.encode(docs(spark), path).withColumn("back", bpe.decode(F.col("ids"), path)).collect()
    for r in out:
        assert bytes(r.back) == (r.text or "").encode()
        assert r.ids == enc.encode_ordinary(r.text or "")


# ---------------------------------------------------------------- SimHash

def plain_fingerprint(text, words=3):
    tokens = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode())
    tokens = [t.lower() for t in tokens]
    shingles = [b" ".join(tokens[i:i + words]) for i in range(max(1, len(tokens) - words + 1))] if tokens else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for _, text, *_ in ROWS:
        if text is None or len(text) < 10_000:
            assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


def test_anchors_cover_and_meet():
    r = np.random.default_rng(1)
    words = r.integers(0, 1 << 31, 400)
    rows, found, home = simhash.anchors(words)
    assert not simhash._syndromes(found).any()
    at = {i: set(found[rows == i].tolist()) for i in range(len(words))}
    homes = dict(zip(rows[home].tolist(), found[home].tolist(), strict=True))
    assert all(bin(int(words[i]) ^ homes[i]).count("1") <= 1 for i in range(len(words)))
    for i, w in enumerate(words.tolist()):  # every word within one bit visits the home
        near = np.array([w] + [w ^ (1 << b) for b in range(31)])
        r2, f2, _ = simhash.anchors(near)
        assert all(homes[i] in f2[r2 == j] for j in range(32))
        assert max(bin(w ^ a).count("1") for a in at[i]) <= 2


def test_links_and_components(spark):
    r = random.Random(3)
    base = [r.getrandbits(64) for _ in range(60)]
    prints = set(base)
    for b in base[:30]:
        for _ in range(4):
            b ^= sum(1 << i for i in r.sample(range(64), r.randint(1, 3)))
            prints.add(b)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = {(x.a, x.b) for x in simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()}
    want = {(min(a, b), max(a, b)) for a in signed for b in signed if a != b and bin((a ^ b) % (1 << 64)).count("1") <= 3}
    assert got == want and want
    parent = {p: p for p in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in want:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    roots = {x.node: x.root for x in simhash.components(spark.createDataFrame(list(got), "a long, b long")).collect()}
    assert roots == {p: find(p) for p in {q for pair in want for q in pair}}


def test_components_of_a_long_chain(spark):
    chain = spark.range(200).selectExpr("id as a", "id + 1 as b")
    assert {r.root for r in simhash.components(chain).collect()} == {0}
    assert simhash.components(chain.where("a < 0")).count() == 0


def test_near_duplicate_rows(spark):
    out = simhash.near_duplicates(clashing(spark)).collect()
    assert len(out) == len(ROWS)
    comp = {(r.doc_id, r.fp): r.component_id for r in out}
    assert comp[(2, simhash.fingerprint(ROWS[0][1]))] == 1
    assert {c for (k, f), c in comp.items() if f == 0} == {3}  # texts without words, one of them without an id
    kept = simhash.first_of_each(docs(spark)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == [(False, i) for i in (1, 3, 6, 7, 8, 9)] + [(True, 0)]
    assert simhash.near_duplicates(empty(spark)).count() == 0 == simhash.first_of_each(empty(spark)).count()


# ---------------------------------------------------------------- suffixes

def plain_removal(texts):
    data = [(t or "").encode() for t in texts]
    met = Counter(b[i:i + 200] for b in data for i in range(len(b) - 199))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 1, int)
        for i in range(len(b) - 199):
            if met[b[i:i + 200]] > 1:
                gone[i] += 1
                gone[i + 200] -= 1
        covered = np.cumsum(gone)[:-1] > 0
        spans = int((np.diff(np.concatenate(([0], covered.astype(int)))) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~covered].tobytes()
        out.append((len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def passages(seed):
    r = random.Random(seed)

    def prose(n):
        return "".join(r.choice("abcdefgh  é\n") for _ in range(n))

    shared = [prose(n) for n in (199, 200, 201, 230, 260, 400, 900)]
    texts = [prose(r.randint(0, 300)) + (r.choice(shared) if r.random() < .7 else "") + prose(r.randint(0, 200)) for _ in range(60)]
    texts += ["abcdef " * 120, "z" * 1500, "xy" * 101, "x" * 200, "q" * 201, texts[0], texts[0] + "tail", None, "", prose(3000) + "ab" * 400 + prose(300)]
    return texts


@pytest.mark.parametrize("most", [200, 2])
def test_removal_equals_a_plain_count(spark, monkeypatch, most):
    monkeypatch.setattr(suffixes, "BUCKET_STRETCHES", most)
    texts = passages(most)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, uid string")
    got = {r.doc_id: tuple(r)[1:] for r in suffixes.measure(df).collect()}
    assert [got[i] for i in range(len(texts))] == plain_removal(texts)


@pytest.mark.parametrize("size", suffixes.GRAMS)
def test_long_texts_are_cut_into_parts(monkeypatch, size):
    monkeypatch.setattr(suffixes, "CHUNK", 700)
    texts = [t for t in passages(9)[:25] if t] + ["mno " * 900]
    for t in texts:
        if len(t) < 200:
            continue
        data = t.encode()
        covered = sorted(i for _, lo, hi, _ in suffixes.stretches(data, size) for a, b in zip(lo, hi, strict=True) for i in range(a, b + 1))
        assert covered == list(range(len(data) - 199))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=200, max_size=420), min_size=1, max_size=4), st.integers(1, 40))
def test_sorted_suffixes(texts, period):
    data = ("".join(t + t[:period] for t in texts)).encode()
    starts = np.arange(len(data) - 199)
    met = Counter(data[i:i + 200] for i in starts)
    assert suffixes.repeated(np.frombuffer(data, np.uint8), starts).tolist() == [met[data[i:i + 200]] > 1 for i in starts]


def test_removed_texts_stay_valid(spark):
    texts = passages(4)
    df = docs(spark, [(i, t, "en", "s", 1) for i, t in enumerate(texts)])
    out = {r.doc_id: r.text for r in suffixes.remove_repeats(df).collect()}
    removed = plain_removal(texts)
    for i, t in enumerate(texts):
        left = removed[i][0] - removed[i][1]
        assert t is None and out[i] is None or left <= len(out[i].encode()) <= left + 4 * removed[i][2]
    assert suffixes.remove_repeats(docs(spark)).columns == docs(spark).columns
    assert suffixes.measure(clashing(spark)).count() == len(ROWS) and suffixes.measure(empty(spark)).count() == 0
