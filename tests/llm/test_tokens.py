import hashlib
import random
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from cutpoint.llm import bpe, packing, token_files
from cutpoint.llm.tokens import load, vocabulary_path, word_ids

ODD = ["", " \t\n\x0b", "Don't STOP", "straße ÉCOLE İstanbul ΣΑΣ Σ", "a\x1cb c d\u0085e", "é ́x", "x<|endoftext|>y <|startoftext|>",
       "<| endoftext |>", "漢字かな 🙂👩‍👩‍👧", "ab" * 5000, "###!!!", "Ａｂｃ ﬁ", "1234 ٣٤ ²³½", "Ǆ ŉ ß ſ K Å", "\u0000​­", "a" + "é" * 300, "ı ļ ł"]


def docs_frame(spark, texts, ids=None):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("ids", T.StringType()), T.StructField("grp", T.StringType())])
    return spark.createDataFrame([(i, t, "x", None) for i, t in zip(ids or range(len(texts)), texts)], schema)


def library_ids(text):
    return load(vocabulary_path()).encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    pool = "abcXYZ éÉßµ'’-.,!#<|>0123 \n\tΣσςİ́­漢🙂"
    return ODD + ["".join(rng.choices(pool, k=rng.randrange(1, 60))) for _ in range(400)]


def test_word_ids_equal_the_library(texts):
    own = word_ids(vocabulary_path())
    for t in texts:
        assert np.frombuffer(own(t.encode()), "<u4").tolist() == library_ids(t), repr(t)


def test_fragment_codec_equals_the_library(texts):
    own = bpe.codec(vocabulary_path())
    for t in texts:
        ids = np.frombuffer(own.encode(t.encode()), "<u4").tolist()
        assert ids == library_ids(t), repr(t)
        assert own.decode(ids) == load(vocabulary_path()).decode(ids, skip_special_tokens=False)


def test_forced_cuts_are_never_crossed():
    own = bpe.codec(vocabulary_path())
    for word in ("xzqqjfqa", "thqdz", "q"):
        fragments = bpe.forced_fragments(word, own.pairs)
        assert "".join(fragments) == word
        assert all(a[-1] + b[0] not in own.pairs for a, b in zip(fragments, fragments[1:]))


def test_bpe_query_rows(spark, texts):
    rows = {r.doc_id: r for r in bpe.digests(docs_frame(spark, [*texts, None, texts[0]])).collect()}
    assert len(rows) == len(texts) + 2
    for i, t in enumerate([*texts, None]):
        ids = library_ids(t)
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        decoded = load(vocabulary_path()).decode(ids, skip_special_tokens=False)
        assert rows[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe.digests(docs_frame(spark, [])).count() == 0


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_round_trip(spark, texts):
    ids = list(range(1000, 1000 + len(texts)))
    random.Random(1).shuffle(ids)
    rows = sorted(token_files.write_and_summarize(docs_frame(spark, texts, ids)).collect(), key=lambda r: r.doc_id)
    start = 0
    for r in rows:
        want = library_ids(texts[ids.index(r.doc_id)]) + [token_files.END_ID]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(want), crc(want))
        start += len(want)
    assert len(rows) == len(texts)
    assert token_files.write_and_summarize(docs_frame(spark, [])).count() == 0


def test_token_files_order_of_nulls_and_repeats(spark):
    got = token_files.write_and_summarize(docs_frame(spark, ["a b", None, "a b", "c"], [7, None, 7, 3])).collect()
    by_start = sorted(got, key=lambda r: r.start)
    assert [(r.doc_id, r.n_tokens) for r in by_start] == [(None, 1), (3, 2), (7, 3), (7, 3)]
    assert [r.start for r in by_start] == [0, 1, 3, 6]


def test_token_files_format(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq
    out = str(tmp_path / "files")
    token_files.write(docs_frame(spark, ["the cat " * 5000] * 40), out, row_group_bytes=1 << 16)
    metas = [pq.ParquetFile(f).metadata for f in glob.glob(out + "/*.parquet")]
    groups = [m.row_group(g) for m in metas for g in range(m.num_row_groups)]
    columns = [g.column(c) for g in groups for c in range(g.num_columns)]
    encodings = {c.path_in_schema: set(c.encodings) for c in columns}
    assert any("DICTIONARY" in e for e in encodings["ids.list.element"])
    assert "DELTA_BINARY_PACKED" in encodings["n_tokens"]
    assert all(c.has_offset_index and c.has_column_index for c in columns)


def test_tournament_is_first_fit_decreasing():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 101, 500)
    order = np.lexsort((np.arange(500), -lengths))
    bins, offsets = packing.first_fit_decreasing(lengths, order, 100)
    free = []
    for i in order:
        b = next((k for k, f in enumerate(free) if f >= lengths[i]), len(free))
        if b == len(free):
            free.append(100)
        assert (bins[i], offsets[i]) == (b, 100 - free[b])
        free[b] -= lengths[i]


def test_packing_covers_every_id_once(spark, texts):
    long = "word " * 9000
    all_texts = [*texts, long, None, "x", "x"]
    rows = packing.pack(packing.cut(docs_frame(spark, all_texts)), group_pieces=50).collect()
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for i, t in enumerate(all_texts):
        want, at = library_ids(t) + [packing.END_ID], 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(want), crc(want[at:at + r.length]))
            at += r.length
        assert at == len(want)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.CAPACITY
    assert packing.pack_documents(docs_frame(spark, [])).count() == 0


def test_packing_pads_little(spark, sf001):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.pack_documents(docs).toPandas()
    padded = rows.sequence_id.nunique() * packing.CAPACITY
    assert 1 - rows.length.sum() / padded < 0.02


def test_plain_range_is_stable_under_normalisation():
    from cutpoint.llm.tokens import PLAIN
    for c in map(chr, range(0x180)):
        if PLAIN.fullmatch(c):
            assert unicodedata.normalize("NFC", c) == c and not c.isspace()
