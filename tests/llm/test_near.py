"""Near copies of the pipeline: against all pairs by brute force."""

import random

import numpy as np
import xxhash
from cases import docs, empty

from tidemerge.llm import near


def plain_set(text):
    words = text.lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def edited_texts():
    """Groups of texts with one to eight words replaced: similarities on both sides of 0.8."""
    r, texts = random.Random(5), []
    for group in range(12):
        base = [f"w{r.randrange(3000)}" for _ in range(r.randint(90, 200))]
        texts.append(" ".join(base))
        for edits in range(1, 9):
            words = list(base)
            for at in r.sample(range(len(words)), edits):
                words[at] = f"new{r.randrange(10_000)}"
            texts.append(" ".join(words))
    return texts


def linked(texts):
    sets = [plain_set(t) for t in texts]
    return {(i, j) for i in range(len(texts)) for j in range(i)
            if len(sets[i] & sets[j]) * 5 >= len(sets[i] | sets[j]) * 4}


def smallest_of(n, pairs):
    low = list(range(n))
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            least = min(low[i], low[j])
            changed |= low[i] != least or low[j] != least
            low[i] = low[j] = least
    return low


def test_pipeline_stage_keeps_one_of_each_group_of_near_copies(spark, folder):
    import corpus_pipeline
    texts = edited_texts()
    pairs = linked(texts)
    low = smallest_of(len(texts), pairs)
    want = {i for i, least in enumerate(low) if least == i}
    assert 12 <= len(want) < len(texts) - 20
    rows = [(i, t, "en", "a", len(t)) for i, t in enumerate(texts)]
    assert {r.doc_id for r in corpus_pipeline.keep_one_of_each(spark, docs(spark, rows), folder).collect()} == want


def test_links_join_what_brute_force_joins(spark):
    texts = edited_texts()
    marked = near.marked_rows(docs(spark, [(i, t, "en", "a", 0) for i, t in enumerate(texts)]), "text")
    at = {r._node: r.doc_id for r in marked.collect()}
    got = {(max(at[x.a], at[x.b]), min(at[x.a], at[x.b])) for x in near.links(marked, "text").collect()}
    want = linked(texts)
    assert got <= want and smallest_of(len(texts), got) == smallest_of(len(texts), want)


def test_awkward_rows(spark):
    kept = near.first_of_each(docs(spark)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == [(False, i) for i in (1, 3, 6, 7, 8, 9)] + [(True, 0)]
    assert near.first_of_each(empty(spark)).count() == 0
    rows = [(1, "A b c", "en", "a", 5), (1, "a  b c", "en", "a", 5), (None, "a b c", "en", "a", 5), (None, "x", "en", "a", 1), (None, "X", "en", "a", 1)]
    assert sorted(r.text for r in near.first_of_each(docs(spark, rows)).collect()) == ["A b c", "X"]


def pairs_of_votes(r, both, one, other, n=40):
    """Votes of pairs of random sets with ``both`` shingles in common."""
    def draw(k):
        return r.integers(0, 1 << 63, k).astype(np.uint64)

    shared = [draw(both) for _ in range(n)]
    return [np.array([near.votes(np.concatenate([s, draw(k)])) for s in shared]) for k in (one, other)]


def test_votes_are_those_of_a_simhash():
    hashes = near.shingles(" ".join(f"w{i}" for i in range(700)))
    words = near.mixed((hashes[:, None] ^ near.SEEDS) * np.uint64(0x9E3779B97F4A7C15))
    plain = [sum(1 if b else -1 for b in column) for column in np.unpackbits(words.view(np.uint8), axis=1).T]
    assert near.votes(hashes).tolist() == plain and len(hashes) > near.AT_A_TIME
    print_ = near.prints(near.votes(hashes)[None])[0].tobytes()
    assert "".join(f"{b:08b}" for b in print_) == "".join("01"[v > 0] for v in plain[:64 * near.PRINT_WORDS])


def test_a_home_is_the_nearest_word_of_the_code():
    code = np.concatenate([near.WORDS.T, -near.WORDS.T])
    assert {int(d) for d in ((code[0] != code[1:]).sum(axis=1))} == {64, 128}  # first-order Reed-Muller
    voted = np.array([near.votes(near.shingles(" ".join(f"{k}-{i}" for i in range(60)))) for k in range(5)])
    found = near.homes(voted, np.full(5, 56))
    for row, t in ((0, 0), (3, 7), (4, near.TABLES - 1)):
        number = int(found[row, t])
        for piece in range(near.PIECES)[::-1]:
            at = near.TAKEN[t].reshape(near.PIECES, -1)[piece]
            signs = near.SIGNS[t].reshape(near.PIECES, -1)[piece]
            fits = near.WORDS.T @ (voted[row, at] * signs)
            word = number % 256
            assert abs(fits[word // 2]) >= abs(fits).max() * 0.9999 and (fits[word // 2] > 0) == word % 2
            number //= 256


def test_sets_of_similarity_0_8_meet_and_unrelated_ones_do_not():
    r = np.random.default_rng(2)
    for both, one, other in ((4, 1, 0), (8, 2, 0), (20, 3, 2), (80, 10, 10), (400, 0, 100)):
        a, b = pairs_of_votes(r, both, one, other)
        same = near.homes(a, np.full(len(a), both + one)) == near.homes(b, np.full(len(b), both + other))
        assert same.any(axis=1).all() and same.mean() > 0.045
        differ = np.bitwise_count((near.prints(a) ^ near.prints(b)).view(np.uint64)).sum(axis=1)
        assert differ.max() <= near.MOST_DIFFERENT
    a, b = pairs_of_votes(r, 2, 100, 100)
    assert (near.homes(a, np.full(len(a), 102)) == near.homes(b, np.full(len(b), 102))).sum() <= 1
    assert np.bitwise_count((near.prints(a) ^ near.prints(b)).view(np.uint64)).sum(axis=1).min() > near.MOST_DIFFERENT


def test_odd_sketches_differ_in_no_more_bits_than_sets_in_shingles():
    r = np.random.default_rng(8)
    for size in (1, 4, 30, 150, 900, 5000):
        a = np.unique(r.integers(0, 1 << 64, size, np.uint64))
        for part in (0, 0.1, 0.5, 1):
            b = np.unique(np.concatenate((a[int(part * size):], r.integers(0, 1 << 64, int(part * size), np.uint64))))
            bits = int(np.bitwise_count((near.odd(a) ^ near.odd(b)).view(np.uint64)).sum())
            assert bits <= len(np.setxor1d(a, b)) and bits % 2 == len(np.setxor1d(a, b)) % 2
    assert not near.odd(np.zeros(0, np.uint64)).any()


def test_a_family_of_texts_that_are_not_near_copies_costs_few_comparisons(spark, monkeypatch):
    r = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    family = [" ".join(w if r.random() > 0.03 else f"{w}x{k}" for w in base) for k in range(60)]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(family)], "doc_id long, text string")
    written, plain = [], near.stored

    def counted(df, label):
        out = plain(df, label)
        if label == "pairs":
            written.append(out.count())
        return out

    monkeypatch.setattr(near, "stored", counted)
    found = {tuple(sorted(p)) for p in near.links(near.marked_rows(rows, "text"), "text").collect()}
    sets = [near.shingles(t) for t in family]
    true = sum(near.similar(sets[i], sets[j]) for i in range(60) for j in range(i))
    assert sum(written) <= 3 * true + 60 < 60 * 59 / 8
    node = {int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).view(np.int64)): i for i, s in enumerate(sets)}
    assert all(near.similar(sets[node[a]], sets[node[b]]) for a, b in found)
    label = list(range(60))
    for i, j in [(node[a], node[b]) for a, b in found]:
        label = [label[i] if x == label[j] else x for x in label]
    assert all(label[i] == label[j] for i in range(60) for j in range(i) if near.similar(sets[i], sets[j]))
