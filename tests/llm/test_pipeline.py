import re
from collections import defaultdict

import corpus_pipeline as P
import numpy as np
import pytest
from cutpoint.llm import convnet, pii
from cutpoint.llm.common import store
from cutpoint.llm.tokens import load, vocabulary_path
from test_jaccard import shingle_set

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def states(spark):
    """The documents before each stage, and the result."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        out.append(store(stage(spark, out[-1], SF), name))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_are_kept(states):
    for df in states[:-1]:
        assert df.dtypes == states[0].dtypes


def test_quality_stage(spark, states):
    before, after = states[0], rows(states[1])
    scores = rows(convnet.score(before, convnet.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))))
    assert set(after) == {i for i, r in scores.items() if r.predicted == 1}
    assert all(after[i] == r for i, r in rows(before).items() if i in after)


def test_exact_stage(states):
    before, after = rows(states[1]), rows(states[2])
    first = {}
    for i in sorted(before):
        first.setdefault(re.sub("[ \t-\r]+", " ", before[i].text or ""), i)
    assert set(after) == set(first.values()) and all(after[i] == before[i] for i in after)


def test_near_stage(states):
    before, after = rows(states[2]), rows(states[3])
    sets = {i: shingle_set(r.text) for i, r in before.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) > 0:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert set(after) == {i for i in ids if find(i) == i} and all(after[i] == before[i] for i in after)


def test_personal_data_stage(states):
    before, after = rows(states[3]), rows(states[4])
    assert set(before) == set(after)
    spans = rows(pii.find(states[3]))
    changed = 0
    for i, r in after.items():
        text, at, out = before[i].text, 0, ""
        for x in sorted(spans[i].spans, key=lambda x: x.start):
            out += text[at:x.start] + f"[{x.kind.upper()}]" if x.start >= at else ""
            at = max(at, x.end)
        assert r.text == out + text[at:]
        assert r.n_chars == (len(r.text) if spans[i].spans else before[i].n_chars)
        changed += bool(spans[i].spans)
    assert changed


def test_packing_stage(states):
    pieces = defaultdict(list)
    for r in states[5].collect():
        pieces[r.doc_id].append(r)
    for i, r in rows(states[4]).items():
        n = len(load(vocabulary_path()).encode(r.text, add_special_tokens=False).ids) + 1
        assert sum(p.length for p in pieces[i]) == n == pieces[i][0].doc_tokens
    by_sequence = defaultdict(int)
    for ps in pieces.values():
        for p in ps:
            by_sequence[p.sequence_id] += p.length
    assert max(by_sequence.values()) <= 4096 and np.mean(list(by_sequence.values())) > 3500


def test_run_gives_the_last_stage(spark, states):
    assert sorted(P.run(spark, SF).select("doc_id", "start", "length").collect()) == sorted(states[5].select("doc_id", "start", "length").collect())
