import collections
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tests.conftest import SF_SMALL
from tickspan.llm import packing as PK, token_count as TC

ODD = [None, "", " ", "  ", "a ", "a  ", "  a  b ", "a▁b", "▁", "▁ x", "x▁", "\n\n a\tb", "<s> </s> <unk>", "𝔘é　ｆ  \xa0z",
       "a" * 30000, "\x00x y", "é ͤx ΑΣ ΣΑ İ<|endoftext|>b <|startoftext|>'s it's", "\x1c \x85  x", "don't 'll 12 3.4"]


@pytest.fixture(scope="module")
def docs(spark):
    base = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "source")
    odd = [(10**6 + i, t, None if i % 3 else "odd") for i, t in enumerate(ODD)] + [(5, "again again", "odd")] * 2 + [(None, "x", "y")]
    return base.unionByName(spark.createDataFrame(odd, "doc_id long, text string, source string")).repartition(3).cache()


def test_token_counts_are_the_librarys(spark, docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(TC.MODEL))
    wide = docs.selectExpr("*", "1 as n_tokens", "'z' as pre", "7 as id", "8 as _row")
    got = collections.Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit)
                              for r in TC.token_counts(wide, broadcast_most=500, chunk=2000, per_chunk=300).collect())
    want = collections.Counter()
    for r in docs.collect():
        n = len(sp.encode(r.text or ""))
        want[(r.doc_id, len((r.text or "").encode()), n, n > 4096)] += 1
    assert got == want


def test_token_counts_without_broadcast_or_with_everything_broadcast(spark, docs):
    a = TC.token_counts(docs, broadcast_most=0).collect()
    b = TC.token_counts(docs, broadcast_most=10**6).collect()
    assert collections.Counter(a) == collections.Counter(b)
    assert TC.token_counts(docs.limit(0)).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["the", "The", "ÉTÉ", "é", "e\u0301", "don't", "it's.", "'s", "...", "&&&", ".", ", ", " ", "\n", "\x1c", "\xa0", "×", "÷.",
                                 "“", "”.", "ß!", "İ", "ΑΣ", "12", "3.5", "<|endoftext|>", "ﬁ", "日本", "𝔘", "\u0300", "K", "x\u200d", "-", "_", "'"]),
                max_size=12).map("".join))
def test_ids_by_words_are_the_librarys(text):
    tok = PK.load(PK.MODEL)
    ids, starts = PK.word_ids(PK.MODEL, "<u2")(pa.array([text, None, text + " x"], pa.string()))
    want = [tok.encode(t, add_special_tokens=False).ids for t in (text, "", text + " x")]
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == want


def test_a_full_cache_changes_nothing():
    texts = [" ".join(f"w{i * j % 97}x" for j in range(60)) for i in range(50)]
    small, large = PK.WordIds(PK.MODEL, "<u4", most=40), PK.WordIds(PK.MODEL, "<u4")
    for i in range(0, 50, 3):
        some = pa.array(texts[i:i + 3])
        assert all(np.array_equal(a, b) for a, b in zip(small(some), large(some)))


def check_pieces(rows, pieces, length=2048):
    tok = Tokenizer.from_file(public_tokenizers.path(PK.MODEL))
    ids = collections.defaultdict(list)
    for r in rows:
        ids[r.doc_id].append(tok.encode(r.text or "", add_special_tokens=False).ids + [1])
    seqs, cover = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        seqs[p.sequence_id].append((p.offset, p.length))
        cover[p.doc_id].append((p.start, p.length))
        assert any(p.doc_tokens == len(x) and p.ids_crc32 == zlib.crc32(np.array(x[p.start:p.start + p.length], "<u4").tobytes())
                   for x in ids[p.doc_id])
    assert sorted(seqs) == list(range(len(seqs)))
    for parts in seqs.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at == length or at & (at - 1) == 0 and at < length
    for d, x in ids.items():
        if len(x) == 1:
            at = 0
            for start, n in sorted(cover[d]):
                assert start == at
                at += n
            assert at == len(x[0])
    assert sum(p.length for p in pieces) == sum(len(x) for v in ids.values() for x in v)


@pytest.mark.parametrize("options", [{}, {"block_docs": 7, "block_rounds": 3, "window": 2},
                                     {"shares": {"src0": 0.6, "none": 0.1}, "window": 4, "length": 512},
                                     {"shares": {"src0": 2.0}, "length": 64, "window": 8}])
def test_packing_keeps_every_id_once(spark, docs, options):
    wide = docs.selectExpr("*", "1 as n", "'z' as queue", "7 as id", "8 as round", "9 as start")
    pieces = PK.pack(wide, **options).collect()
    check_pieces(docs.collect(), pieces, options.get("length", 2048))


def test_windows_hold_the_wanted_mixture(spark):
    rows = [(i, "one two three four five " * 20, "abc"[i % 3]) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    pieces = PK.pack(docs, length=256, window=16, shares={"a": 0.5, "b": 0.3, "c": 0.2}).collect()
    mix = collections.defaultdict(collections.Counter)
    for p in pieces:
        mix[p.round][p.source] += p.length
    until_dry = [mix[r] for r in sorted(mix) if set(mix[r]) == {"a", "b", "c"}][:-1]
    assert len(until_dry) >= 10
    for source, share in (("a", 0.5), ("b", 0.3), ("c", 0.2)):
        sent = np.cumsum([m[source] for m in until_dry])
        granted = np.arange(1, len(sent) + 1) * share * 16 * 256
        assert (granted - sent >= 0).all() and (granted - sent < 256).all()      # the deficit: under one segment


def test_packing_of_an_empty_table(spark, docs):
    assert PK.pack(docs.limit(0)).collect() == []


def test_long_documents_are_stored_in_segments(spark):
    df = spark.createDataFrame([(1, "one two " * 200_000, "a"), (2, "x", None), (3, "", "")], "doc_id long, text string, source string")
    rows = PK.tokenized(df, "doc_id", "text", "source", PK.MODEL, 1, 2048)
    assert rows.selectExpr("max(octet_length(ids))").first()[0] == 4096 and rows.count() == 2 + -(-400_001 // 2048)
    pieces = PK.pack(df).collect()
    check_pieces(df.collect(), pieces)
    assert {p.doc_id: p.source for p in pieces} == {1: "a", 2: None, 3: ""}


def test_a_repeated_id_takes_many_blocks(spark):
    df = spark.range(4000).selectExpr("if(id < 3000, 7, null) AS doc_id", "concat('w', id) AS text", "'s' AS source").repartition(4)
    pieces = PK.pack(df, block_docs=100)
    assert sum(p.length for p in pieces.collect()) > 8000
    rows = PK.tokenized(df, "doc_id", "text", "source", PK.MODEL, 1, 2048)
    assert rows.select("_row").distinct().count() == 4000
