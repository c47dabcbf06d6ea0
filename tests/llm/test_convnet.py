import zlib

import numpy as np
from pyspark.sql import types as T

from cutpoint.llm import convnet

DOCS = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("score", T.StringType()), ("quality", T.LongType()))])
LABELS = "doc_id long, quality int, toxic int"


def test_chunks_cover_every_byte():
    for size in [*range(0, 1200), 5000]:
        covered = np.zeros(size, bool)
        for a in convnet.chunk_starts(size):
            covered[a:a + convnet.CHUNK] = True
        assert covered.all()


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = convnet.Net(*(w.astype(np.float64) for w in convnet.start(3)))
    chunks = [bytes(rng.integers(0, 256, n, dtype=np.uint8)) for n in (0, 5, 100, 256)]
    ids, lengths = convnet.chunk_matrix(chunks)
    y = np.array([0., 1, 1, 0])

    def loss():
        z = convnet._head(net, convnet._responses(net, ids, lengths)[1].max(axis=1), lengths)[2]
        return np.mean(np.log1p(np.exp(z)) - y * z)
    grads = convnet.gradients(net, ids, lengths, y)
    for w, g in zip(net, grads):
        for at in [tuple(rng.integers(0, n) for n in w.shape) for _ in range(6)]:
            if w is net.embed and at[0] == 0:
                continue
            keep = w[at]
            w[at] = keep + 1e-5
            up = loss()
            w[at] = keep - 1e-5
            down = loss()
            w[at] = keep
            assert abs((up - down) / 2e-5 - g[at]) < 2e-3


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    net = convnet.fit(docs, labels)
    rows = (convnet.score(docs, net).join(labels.groupBy("doc_id").min("quality"), "doc_id").where("held_out")
            .withColumnRenamed("min(quality)", "y").collect())
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    good = [r.predicted for r in rows if r.y == 1]
    bad = [r.predicted for r in rows if r.y == 0]
    assert len(good) > 400 and len(bad) > 60
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.1


def test_odd_rows_and_missing_labels(spark):
    texts = [None, "", " ", "plain words here", "plain words here", "é" * 100_000]
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in enumerate(texts)] + [(None, "x", None, None)], DOCS)
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0)], LABELS)
    assert convnet.fit(docs, labels) == 0.5
    rows = convnet.score(docs, 0.5).collect()
    assert len(rows) == 7 and {r.score for r in rows} == {0.5}
    net = convnet.start()
    by = {r.doc_id: r for r in convnet.score(docs, net).collect()}
    assert by[0].score == by[1].score and abs(by[3].score - by[4].score) < 1e-5 and not by[None].held_out
    assert convnet.keep(docs, net, 2.0).count() == 0
    kept = convnet.keep(docs, net, 0.0)
    assert kept.columns == docs.columns and kept.count() == 7
    assert convnet.score(docs.limit(0), net).count() == 0


def test_document_scores_equal_one_by_one():
    rng = np.random.default_rng(1)
    net = convnet.start(4)
    texts = [bytes(rng.integers(32, 127, n, dtype=np.uint8)) for n in (0, 1, 255, 256, 257, 900)]
    whole = convnet.document_scores(net, texts)
    for t, p in zip(texts, whole):
        z = [float(convnet.chunk_logits(net, [t[a:a + 256]])[0]) for a in convnet.chunk_starts(len(t))]
        assert abs(p - 1 / (1 + np.exp(-np.mean(z)))) < 1e-5
