"""The language model's filter holds all levels at every size."""

import random

import pytest
from cases import ROWS, docs

from tidemerge.llm import lm


def test_scores_are_the_same_with_blocks_broadcast_and_as_a_table(spark, monkeypatch):
    r = random.Random(4)
    more = [(100 + i, " ".join(f"w{int(r.paretovariate(0.7)) % 5000}" for _ in range(300)), "en", "a", 1) for i in range(60)]
    d = docs(spark, ROWS + more)
    counts = lm.stored(lm.counted(d), "test-counts")
    monkeypatch.setattr(lm, "BITS_PER_ITEM", 900)  # several blocks for few items
    assert 4 < lm.n_blocks(counts) <= lm.MAX_BLOCKS

    def rows():
        return sorted(((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6))
                       for r in lm.scored(d, counts).collect()))

    broadcast = rows()
    monkeypatch.setattr(lm, "MAX_BLOCKS", 2)
    assert rows() == broadcast and len(broadcast) == len(ROWS) + 60


@pytest.mark.parametrize("most", [1, 256])
def test_no_level_is_dropped_and_words_seen_once_are_held(spark, monkeypatch, most):
    monkeypatch.setattr(lm, "BITS_PER_ITEM", 900)
    monkeypatch.setattr(lm, "MAX_BLOCKS", most)
    hashes = [random.Random(i).getrandbits(63) for i in range(4000)]
    made = lm.build_filter(spark.createDataFrame([(1, h, 1) for h in hashes[:2000]] + [(2, h, 2) for h in hashes[2000:]], "gram int, h long, c long"))
    h = lm.np.array(hashes, lm.np.uint64)
    assert made.cut == lm.CUT_LEVEL and (made.counts(h[:2000], 1) >= 1).all() and (made.counts(h[2000:]) >= 2).all()


def test_texts_are_split_once_for_a_filter_that_is_a_table(spark, monkeypatch):
    written, plain = {}, lm.stored
    monkeypatch.setattr(lm, "stored", lambda df, label: written.setdefault(label, plain(df, label)))
    monkeypatch.setattr(lm, "BITS_PER_ITEM", 9000)
    monkeypatch.setattr(lm, "MAX_BLOCKS", 2)
    d = docs(spark)
    assert lm.scored(d, plain(lm.counted(d), "test-counts")).count() == len(ROWS)
    assert {"asked", "answers", "lm"} <= set(written) and "text" not in written["asked"].columns
    assert written["answers"].groupBy("chunk", "block").count().where("count > 1").isEmpty()
