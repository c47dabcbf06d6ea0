import numpy as np
from pyspark.sql import types as T

from cutpoint.llm import pseudo_likelihood as lm
from cutpoint.llm import shingles

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n_tokens", T.StringType())])


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], SCHEMA)


def small_net(rng):
    counts = rng.integers(1, 50, lm.PAD)
    return lm.Net(*(w.astype(np.float64) + rng.standard_normal(w.shape) * 0.05 for w in lm.start(counts)))


def brute(net, ids):
    """Sum over the tokens by the definition, one token at a time."""
    total = 0.0
    for t, own in enumerate(ids):
        near = [ids[t + k] if 0 <= t + k < len(ids) else lm.PAD for k in (-2, -1, 1, 2)]
        h = np.tanh(np.concatenate([net.embed[i] for i in near]) @ net.hidden + net.hidden_shift)
        c, w = divmod(int(own), lm.IN_CLASS)
        for z, k in ((h @ net.classes + net.class_shift, c), (h @ net.words[c] + net.word_shift[c], w)):
            total += z[k] - np.log(np.exp(z).sum())
    return total


def test_scores_equal_the_definition(spark):
    rng = np.random.default_rng(0)
    net = small_net(rng)
    texts = [None, "", " \n", "one", "a b", "A b C d e f g", "the cat sat on the mat " * 40, "the cat sat on the mat " * 40]
    vocab = lm.Vocabulary(np.unique(shingles.word_hashes([b"the cat sat a b"])[0]), np.zeros(lm.PAD))
    rows = {r.doc_id: r for r in lm.score(frame(spark, texts), vocab, net).collect()}
    for i, t in enumerate(texts):
        ids = vocab(shingles.word_hashes([(t or "").encode()])[0])
        assert rows[i].n_tokens == len(ids) and abs(rows[i].log_likelihood - brute(net, ids)) < 1e-6 * max(1, len(ids))
        assert (rows[i].perplexity is None) == (not len(ids))
    assert lm.score(frame(spark, []), vocab, net).count() == 0


def test_probabilities_sum_to_one():
    net = small_net(np.random.default_rng(1))
    around = np.tile(np.array([[5, 6, 7, 8]], np.int32), (lm.PAD, 1))
    p = lm.log_probabilities(net, np.arange(lm.PAD, dtype=np.int32), around)
    assert abs(np.exp(p).sum() - 1) < 1e-9


def test_learning_follows_the_gradient():
    rng = np.random.default_rng(2)
    net = small_net(rng)
    ids, around = rng.integers(0, lm.PAD, 64), rng.integers(0, lm.PAD + 1, (64, 4))
    before = {k: getattr(net, k).copy() for k in net._fields}

    def loss(n):
        return -lm.log_probabilities(n, ids, around).mean()
    moved = lm.Net(*(w.copy() for w in net))
    lm.learn(moved, ids, around, 1e-3)
    for k in net._fields:
        scale = 4 if k == "embed" else 1
        step = (before[k] - getattr(moved, k)) / 1e-3 / scale
        at = np.unravel_index(np.abs(step).argmax(), step.shape)
        w = getattr(net, k)
        w[at] += 1e-5
        up = loss(net)
        w[at] -= 2e-5
        down = loss(net)
        w[at] += 1e-5
        assert abs((up - down) / 2e-5 - step[at]) < 1e-4, k


def test_counts_and_training_beat_single_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [r.text.encode() for r in docs.select("text").collect()]
    values, n = np.unique(shingles.word_hashes(texts)[0], return_counts=True)
    got = {r.word: r.n for r in lm.word_counts(docs).collect()}
    assert got == dict(zip(values.view(np.int64).tolist(), n.tolist()))
    # Documents outside the trained ones: context must help against the word counts alone.
    trained, rest = docs.where("doc_id % 5 <> 0"), docs.where("doc_id % 5 = 0")
    vocab = lm.vocabulary(trained)
    assert vocab.counts.sum() == sum(r.n for r in lm.word_counts(trained).collect()) and vocab.counts.min() >= 0
    net = lm.train(trained, vocab, every=2)
    plain, own = ((lm.score(rest, vocab, n).agg({"log_likelihood": "sum", "n_tokens": "sum"}).first()) for n in (lm.start(vocab.counts), net))
    assert own["sum(log_likelihood)"] / own["sum(n_tokens)"] > plain["sum(log_likelihood)"] / plain["sum(n_tokens)"] + 0.03
    assert lm.score_corpus(docs.limit(0)).count() == 0


def test_every_place_is_learned_once(spark, monkeypatch):
    texts = [f"w{i} the w{i % 7} end of w{i % 97}" for i in range(3001)] + ["one", "a b", "", None]
    hashes, bounds = shingles.word_hashes([(t or "").encode() for t in texts])
    vocab = lm.Vocabulary(np.unique(hashes), np.ones(lm.PAD))
    learned = []
    monkeypatch.setattr(lm, "learn", lambda net, ids, around, rate: learned.append((np.column_stack([ids, around]), rate)))
    monkeypatch.setattr(lm, "gather", lambda df, fill, kind: fill(df.toArrow().to_batches()))
    lm.train(frame(spark, texts), vocab)
    ids = vocab(hashes)
    want = np.column_stack([ids, lm.neighbours(ids, bounds)])
    got = np.concatenate([x for x, _ in learned])
    assert sorted(map(tuple, got.tolist())) == sorted(map(tuple, want.tolist()))
    # A short batch moves the network by its share.
    assert all(rate in {len(x) / lm.BATCH / (1 + turn) for turn in range(lm.ROUNDS)} for x, rate in learned)


def test_every_word_has_a_probability_of_its_own(spark):
    # Each of 5 frequent words 20 times, 60 rare ones once to three times each; 5 ids of their own.
    rare = [f"rare{i}" for i in range(60)]
    texts = ["the cat sat on mat " * 20, *(" ".join([w] * (1 + i % 3)) for i, w in enumerate(rare)), None, " "]
    docs = frame(spark, texts)
    vocab = lm.vocabulary(docs, known=5)
    net = lm.start(vocab.counts)
    asked = [*rare, "neverseen", "the", "rare0 the rare0 neverseen rare1", "", None]
    twice = frame(spark, asked).unionByName(frame(spark, asked).withColumn("doc_id", lm.F.lit(None).cast("long")))
    rows = lm.score(twice, vocab, net).collect()
    assert len(rows) == 2 * len(asked) and sum(r.doc_id is None for r in rows) == len(asked)

    counts = {w: 1 + i % 3 for i, w in enumerate(rare)}
    place = {w: int(vocab(shingles.word_hashes([w.encode()])[0])[0]) for w in [*rare, "neverseen"]}

    def within(w):
        if w not in place:
            return 0.0
        same = [x for x in rare if place[x] == place[w]]
        return np.log((counts.get(w, 0) + 0.5) / (sum(counts[x] for x in same) + 0.5 * (len(same) + 1)))
    for r in rows:
        if r.doc_id is not None:
            words = (asked[r.doc_id] or "").split()
            want = brute(net, vocab(shingles.word_hashes([" ".join(words).encode()])[0])) + sum(map(within, words))
            assert r.n_tokens == len(words) and abs(r.log_likelihood - want) < 1e-5, words
    # The words of a bucket and one never counted share the bucket's probability.
    for b in {place[w] for w in rare}:
        assert abs(sum(np.exp(within(w)) for w in rare if place[w] == b) + 0.5 / (sum(counts[w] for w in rare if place[w] == b) + 0.5 * (sum(place[w] == b for w in rare) + 1)) - 1) < 1e-9


def plain_step(net, ids, around, rate):
    """One step by the definition, one place at a time."""
    grads = [np.zeros_like(w) for w in net]
    e, hid, hs, cl, cs, wo, ws = grads
    for own, near in zip(ids, around, strict=True):
        x = net.embed[near].ravel()
        h = np.tanh(x @ net.hidden + net.hidden_shift)
        c, w = divmod(int(own), lm.IN_CLASS)
        d = []
        for z, k in ((h @ net.classes + net.class_shift, c), (h @ net.words[c] + net.word_shift[c], w)):
            p = np.exp(z - z.max())
            p /= p.sum()
            p[k] -= 1
            d.append(p / len(ids))
        back = (net.classes @ d[0] + net.words[c] @ d[1]) * (1 - h * h)
        cl += np.outer(h, d[0])
        cs += d[0]
        wo[c] += np.outer(h, d[1])
        ws[c] += d[1]
        hid += np.outer(x, back)
        hs += back
        np.add.at(e, near, 4 * (net.hidden @ back).reshape(-1, lm.EMBED))
    return lm.Net(*(w - rate * g for w, g in zip(net, grads, strict=True)))


def test_a_step_equals_its_definition_whatever_the_classes():
    rng = np.random.default_rng(3)
    for n, most, scale in ((1, lm.PAD, 1), (7, 64, 1), (300, lm.PAD, 1), (300, 1, 1), (200, 500, 1), (64, lm.PAD, 300)):
        net = small_net(rng)
        net.word_shift[...] *= scale        # beyond the range of exp in one step
        net.class_shift[...] *= scale
        ids, around = rng.integers(0, most, n).astype(np.int32), rng.integers(0, lm.PAD + 1, (n, 4)).astype(np.int16)
        want, moved = plain_step(net, ids, around, 0.5), lm.Net(*(w.copy() for w in net))
        lm.learn(moved, ids, around, 0.5)
        for k in net._fields:
            assert np.allclose(getattr(moved, k), getattr(want, k), rtol=1e-9, atol=1e-10), (n, most, scale, k)
        assert abs(lm.log_probabilities(net, ids, around).sum() - sum(
            brute_place(net, i, a) for i, a in zip(ids, around, strict=True))) < 1e-6 * n


def brute_place(net, own, near):
    h = np.tanh(net.embed[near].ravel() @ net.hidden + net.hidden_shift)
    c, w = divmod(int(own), lm.IN_CLASS)
    total = 0.0
    for z, k in ((h @ net.classes + net.class_shift, c), (h @ net.words[c] + net.word_shift[c], w)):
        total += z[k] - z.max() - np.log(np.exp(z - z.max()).sum())
    return total


def test_texts_are_coded_once_for_rounds_and_scores(spark):
    texts = [None, "", "the cat sat", " ", "a b c d e f the the", *(f"w{i} w{i % 7}" for i in range(50)), "the cat sat"]
    docs = frame(spark, texts)
    hashes, bounds = shingles.word_hashes([(t or "").encode() for t in texts])
    vocab = lm.Vocabulary(np.unique(hashes)[::3], np.ones(lm.PAD))
    for every in (2, 20):
        coded = lm.encode(docs, vocab, every).orderBy("doc_id")
        ids, turns, ends = lm.decode(coded.select("code").toArrow().combine_chunks().to_batches()[0], every)
        place = np.concatenate([np.arange(n) for n in np.diff(bounds)]).astype(np.uint64)
        assert ids.tolist() == vocab(hashes).tolist() and ends.tolist() == bounds.tolist()
        assert turns.tolist() == (shingles.mix(hashes ^ place) % np.uint64(every)).tolist()
    # Rounds and scores read the stored codes, not the texts.
    coded, other = lm.encode(docs, vocab), frame(spark, ["something else"])
    net = lm.train(other, vocab, coded=coded)
    assert not np.array_equal(lm.flat(net), lm.flat(lm.start(vocab.counts)))
    got = {r.doc_id: r for r in lm.score(other, vocab, net, coded).collect()}
    assert [got[i].n_tokens for i in range(len(texts))] == np.diff(bounds).tolist()
    assert lm.encode(frame(spark, [None, ""]), vocab).count() == 2


def test_words_are_found_among_hashes_that_begin_alike():
    rng = np.random.default_rng(4)
    near = np.uint64(0xABCD) << np.uint64(48)
    known = np.unique(np.concatenate([near + rng.integers(0, 50, 30).astype(np.uint64), rng.integers(0, 2**63, 500).astype(np.uint64) * np.uint64(2),
                                      np.array([0, 2**64 - 2], np.uint64)]))
    ranked = rng.permutation(known)
    asked = np.concatenate([known, near + np.arange(60, dtype=np.uint64), rng.integers(0, 2**63, 500).astype(np.uint64), np.array([2**64 - 1, 1], np.uint64)])
    place = {int(h): i for i, h in enumerate(ranked)}
    want = [place.get(int(h), lm.KNOWN + int(h) % lm.OTHERS) for h in asked]
    assert lm.Vocabulary(ranked, np.ones(lm.PAD))(asked).tolist() == want
    assert lm.Vocabulary(ranked[:0], np.ones(lm.PAD))(asked).tolist() == [lm.KNOWN + int(h) % lm.OTHERS for h in asked]


def test_frequent_words_are_scored_without_the_join(spark):
    # Counts 40, 20, 10, 5 and 1 (of 30 words); 3 ids of their own.
    texts = ["a the cat sat " * 5, "a the cat " * 5, "a the " * 10, "a " * 20, " ".join(f"rare{i}" for i in range(30)), None, ""]
    docs = frame(spark, texts)
    asked = frame(spark, [*texts, "sat rare1 neverseen rare1 sat sat", "a neverseen"])
    scores, listed = {}, {}
    for frequent in (0, 3, 20, 34):
        vocab = lm.vocabulary(docs, known=3, frequent=frequent)
        coded = lm.encode(asked, vocab)
        listed[frequent] = {r.doc_id: dict(zip(r.word, r.times, strict=True)) for r in coded.collect()}
        scores[frequent] = {r.doc_id: r for r in lm.score(asked, vocab, lm.start(vocab.counts), coded).collect()}
    own = {w: shingles.word_hashes([w.encode()])[0].view(np.int64)[0] for w in ("sat", "rare1", "neverseen")}
    assert listed[0][7] == listed[3][7] == {own["sat"]: 3, own["rare1"]: 2, own["neverseen"]: 1}
    assert listed[20][7] == {own["rare1"]: 2, own["neverseen"]: 1}
    assert listed[34][7] == listed[34][8] == {own["neverseen"]: 1} and not listed[34][4]
    for frequent in (3, 20, 34):
        for i, r in scores[0].items():
            got = scores[frequent][i]
            assert got.n_tokens == r.n_tokens and abs(got.log_likelihood - r.log_likelihood) < 1e-9, (frequent, i)


def test_frequent_words_are_bounded_and_exact(spark):
    n = np.random.default_rng(5).zipf(1.3, 3000).clip(max=10**9)
    words = spark.createDataFrame([(int(h), int(k)) for h, k in zip(lm.shingles.keys(1, 3000).view(np.int64), n, strict=True)], lm.WORDS)
    of = {r.word: r.n for r in words.collect()}
    for most in (0, 1, 10, 500, 2999, 3000, 10**6):
        word, k = lm.most_frequent(words, most)
        assert len(word) <= most and (np.diff(word.astype(object)) > 0).all()
        assert [of.pop(w) if most == 10**6 else of[w] for w in word.view(np.int64).tolist()] == k.tolist()
        rest = np.sort(n)[:3000 - len(word)]
        assert not len(word) or not len(rest) or k.min() > rest.max()
    assert not of
    assert len(lm.most_frequent(words.limit(0), 10)[0]) == 0
