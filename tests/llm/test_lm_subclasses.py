"""Words beyond the most frequent ones in the language model."""

import numpy as np

from tests.llm.conftest import frame
from tidewater.llm import lm_score


def test_ordinary_words_are_told_apart(spark):
    """Words beyond the most frequent ones, each always followed by the same one."""
    rng = np.random.default_rng(4)

    def text(pairs):
        return " ".join(" ".join([*(f"top{t}" for t in rng.integers(0, 511, 3)), f"a{a}", f"b{b}"]) for a, b in pairs)

    def drawn(n):
        return [(k, k) for k in rng.integers(0, 400, n)]

    rows, same = [(k, text(drawn(50))) for k in range(300)], drawn(400)
    state = rng.bit_generator.state
    right = text(same)
    rng.bit_generator.state = state
    wrong = text(zip([a for a, _ in same], [b for _, b in same[1:] + same[:1]]))
    docs = frame(spark, rows + [(1000, right), (1001, wrong)], 2)
    out = {r.doc_id: r for r in lm_score.lm_scores(docs, docs.where("doc_id < 1000")).collect()}
    assert abs(out[1000].base_score - out[1001].base_score) < 1e-6
    assert out[1000].score > out[1001].score + 20


def test_subclasses_follow_the_corpus_and_cover_all_other_words(spark):
    sizes = []
    for n in (2000, 8000):
        docs = frame(spark, [(k, " ".join(f"w{(k * 500 + j) % n}" for j in range(500))) for k in range(n // 100)], 2)
        _, words = lm_score.count_words(docs)
        sizes.append(len(words.sub_counts))
        assert words.sub_counts.sum() == words.class_counts[-1] and words.sub_kinds.sum() == words.distinct - words.other
    assert 1.9 < sizes[1] / sizes[0] < 2.1


def test_probabilities_of_classes_and_subclasses_add_up_to_one():
    words = lm_score.Words(np.array([1, 2], np.uint64), np.array([5, 4]), np.arange(2), np.array([5, 4, 30]), 39, 12,
                           np.full(2, -1), 3, np.array([9., 6, 5, 4, 3, 2, 1]), np.array([1., 1, 1, 3, 2, 2, 1]))
    model, rng = lm_score._start(words), np.random.default_rng(2)
    part = (np.full(4000, 2), rng.integers(0, 11, 4000), rng.integers(0, 11, 4000), rng.integers(0, 7, 4000))
    model, _ = lm_score.train(model, iter([part]), np.exp(model.bias), 1)
    z = lm_score.normalisers(model)
    for a, b in ((0, 3), (2, 9), (10, 4), (3, 3)):
        word, sub = np.array([0, 1] + [2] * 7), np.array([-1, -1, *range(7)])
        p = np.exp(lm_score.class_logs(model, z, word, np.full(9, a), np.full(9, b), sub))
        assert abs(p.sum() - 1) < 1e-5


def test_words_are_found_by_their_start():
    rng = np.random.default_rng(6)
    for n in (0, 1, 2, 7, 1000):
        hashes = np.unique(rng.integers(0, 1 << 64, n, np.uint64))
        for some in (hashes, hashes >> np.uint64(30)):      # also where all share a start
            plain = lm_score.Words(some, np.ones(n), np.zeros(n, np.int32), np.array([n, 0]), n, n)
            tokens = np.concatenate([some, some + np.uint64(1), rng.integers(0, 1 << 64, 500, np.uint64), np.array([0, 2 ** 64 - 1], np.uint64)])
            for x, y in zip(plain.find(tokens), plain.indexed().find(tokens)):
                assert (x == y).all()


def test_sums_of_pairs_come_from_factors_unless_they_are_too_large(monkeypatch):
    words = lm_score.Words(np.array([1, 2], np.uint64), np.array([5, 4]), np.arange(2), np.array([5, 4, 30]), 39, 12,
                           np.full(2, -1), 3, np.array([9., 6, 5, 4, 3, 2, 1]), np.array([1., 1, 1, 3, 2, 2, 1]))
    model = lm_score.Model(*(x.astype(np.float32) for x in lm_score._start(words)))
    n = len(model.first)
    one, two = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(n)))
    plain, direct = lm_score._log_sums, []
    monkeypatch.setattr(lm_score, "_log_sums", lambda q, *x: direct.append(len(q)) or plain(q, *x))
    monkeypatch.setattr(lm_score, "_CACHED", 256)
    # All contexts by factors, only the first four, and none as products are too large.
    for size, by, left in ((1 << 23, 1, 0), (12, 1, n * n - 16), (1 << 23, 1000, n * n)):
        monkeypatch.setattr(lm_score, "_FACTORS", size)
        own = model._replace(first=model.first * np.float32(by))
        q = own.first[one] + own.second[two]
        direct.clear()
        got = lm_score.PairSums(own, own.target, own.bias).of(one * n + two, q)
        assert sum(direct) == left
        assert np.allclose(got, plain(q, own.target, own.bias), rtol=1e-5, atol=1e-5)
