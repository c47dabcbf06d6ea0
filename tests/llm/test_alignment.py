import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import types as T

from cutpoint.llm import alignment
from cutpoint.llm.tokens import byte_letters, load, vocabulary_path

SCHEMA = T.StructType([T.StructField(n, t) for n, t in (
    ("doc_id", T.LongType()), ("text", T.StringType()), ("chunk", T.StringType()), ("a", T.LongType()), ("n", T.LongType()))])

ODD = [None, "", " ", "\n", "  \n ", "a", "  x", "x\n\n\ny", "</s><s><unk>", "<|endoftext|> a", "a▁b", "x;\r\ny", "<0x0A>",
       "word\n", "it's John's; we'll", "tab\t \n x", "a  b  \n c", "漢字かな 🙂👩‍👩‍👧", "ab" * 3000, "x, y.z!? (q) #### a_b", "\u0000 b",
       "é ñezll ß ſ"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    pool = "abcXYZ éÉ'’-.,!#<|>0123 \n\n  \t\r\x1c\xa0漢🙂;)}{s"
    words = ["the", "of", "ñezll", "ación", "hello,", "World.", "über", "x1", "(see", "below)", "don't", "\n", "\n\n", " "]
    return (ODD + ["".join(rng.choices(pool, k=rng.randrange(1, 60))) for _ in range(150)]
            + [" ".join(rng.choices(words, k=rng.randrange(1, 80))) for _ in range(150)])


def whole_tokens(text):
    """Token ids and bytes of the two libraries over a whole text; None where it has no tokens."""
    import sentencepiece
    if not text:
        return None
    a_tok = load(vocabulary_path(alignment.A_FILE))
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(alignment.B_FILE))
    value = {c: b for b, c in enumerate(byte_letters())}
    a, b = a_tok.encode(" " + text, add_special_tokens=False).ids, b_tok.encode(text)
    a_bytes = [bytes(value[c] for c in a_tok.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i) else b_tok.id_to_piece(i).replace("▁", " ").encode()
               for i in b]
    want = (" " + text).encode()
    return (a, a_bytes, b, b_bytes) if b"".join(a_bytes) == want == b"".join(b_bytes) else None


def brute(rows):
    docs = []
    for doc_id, text in rows:
        found = whole_tokens(text)
        if found is None:
            docs.append((doc_id, 0, 0, [], ""))
            continue
        a, a_bytes, b, b_bytes = found
        a_end, b_end = np.cumsum([len(x) for x in a_bytes]), np.cumsum([len(x) for x in b_bytes])
        a_from, b_from = a_end - [len(x) for x in a_bytes], b_end - [len(x) for x in b_bytes]
        linked = [(x, y) for i, x in enumerate(a) for j, y in enumerate(b) if a_from[i] < b_end[j] and b_from[j] < a_end[i]]
        groups, last = [], 0
        for end in sorted(set(a_end) & set(b_end)):
            groups.append(",".join(str(x) for x, e in zip(a, a_end) if last < e <= end) + "|"
                          + ",".join(str(y) for y, e in zip(b, b_end) if last < e <= end))
            last = end
        docs.append((doc_id, len(a), len(b), linked, ";".join(groups)))
    n = Counter(p for d in docs for p in set(d[3]))
    best = {}
    for (x, _), k in n.items():
        best[x] = max(k, best.get(x, 0))
    return sorted(((i, a, b, g.count("|"), len(linked), sum(n[p] == best[p[0]] for p in linked), sum(n[p] for p in linked),
                    hashlib.sha256(g.encode()).hexdigest() if g else "") for i, a, b, linked, g in docs), key=str), n, docs


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "c", 1, 2) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows(texts):
    return list(enumerate(texts)) + [(5, texts[30])] * 2 + [(None, texts[40])] + [(2000 + i, "the of the of, hello") for i in range(90)]


def test_fragments_equal_the_libraries(texts):
    own = alignment.aligner(vocabulary_path(alignment.A_FILE), vocabulary_path(alignment.B_FILE))
    assert own.cuts
    for t in texts:
        if t:
            assert own(t.encode()) == own._fragment(" " + t), repr(t)


@pytest.mark.parametrize("docs_a_chunk", [alignment.CHUNK_DOCS, 7])
def test_align_equals_brute_force(spark, rows, docs_a_chunk):
    got = alignment.align(frame(spark, rows).coalesce(3), chunk_docs=docs_a_chunk)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)[0]


def test_links_count_documents_and_occurrences(spark, rows):
    _, n, docs = brute(rows)
    links = Counter(p for d in docs for p in d[3])
    got = {(r.a, r.b): (r.n, r.links) for r in alignment.links(frame(spark, rows)).collect()}
    assert got == {p: (n[p], links[p]) for p in n}


def test_bitmaps_and_planes_round_trip():
    rng = np.random.default_rng(2)
    for size in (1, 9, 200, 1000):
        pairs = rng.choice([3, 70_000, 1_600_000_000], 5000, p=[0.7, 0.29, 0.01]).astype("<u4")
        places = np.sort(rng.integers(0, size, 5000))
        pair, n, bits, planes = alignment.postings(pairs, places, size)
        owner, at, links = alignment.read_postings(n, bits.to_pylist(), planes.to_pylist(), size)
        assert Counter({(int(pair[o]), int(p)): int(k) for o, p, k in zip(owner, at, links)}) == Counter(
            zip(pairs.tolist(), places.tolist()))


def test_empty_table(spark):
    assert alignment.align(frame(spark, [])).count() == 0
    assert alignment.align(frame(spark, [(1, None), (2, "")])).count() == 2
