import collections
import functools
import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tests.conftest import SF_SMALL
from tickspan.llm import alignment as AL

ODD = [None, "", " ", "  ", "a ", "a  ", "  a  b ", "a▁b", "▁", "▁ x", "x▁ y z", "\n\n a\tb", "<s> </s> <unk> <0x41>", "𝔘é　ｆ  \xa0z", "q　 r",
       "ab" * 15000, "\x00x y", "é ͤx ΑΣ <|endoftext|>b <|startoftext|>'s it's", "\x1c \x85  x", "don't 'll 12 3.4", "ﬁ ｱ 日本語 テキスト", "x", "x"]


@functools.lru_cache(maxsize=1)
def libraries():
    tok = Tokenizer.from_file(public_tokenizers.path(AL.MODEL_A))
    tok.encode_special_tokens = True
    return (tok, {i: t for t, i in tok.get_vocab().items()}, AL.byte_of_char(),
            sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(AL.MODEL_B)))


def plain_tokens(text):
    """Ids and bytes of both sides straight from the libraries."""
    tok, shown, of, sp = libraries()
    a = tok.encode(" " + text, add_special_tokens=False).ids
    bytes_a = [bytes(of[c] for c in shown[i]) for i in a]
    b = sp.encode(text)
    bytes_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
    return a, bytes_a, b, bytes_b


def brute(texts):
    """Every pair of tokens compared; groups from the sets of ends."""
    docs, count = [], collections.Counter()
    for text in texts:
        a, ba, b, bb = plain_tokens(text) if text else ([], [], [], [])
        if not text or not (b"".join(ba) == b"".join(bb) == (" " + text).encode()):
            docs.append((0, 0, 0, [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in ba]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
        links, j = [], 0
        for i, e in enumerate(ends_a):
            s = ends_a[i - 1] if i else 0
            while j < len(b) and ends_b[j] <= s:
                j += 1
            k = j
            while k < len(b) and (ends_b[k - 1] if k else 0) < e:
                links.append((a[i], b[k]))
                k += 1
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, i, j = [], 0, 0
        for c in cuts:
            i2, j2 = ends_a.index(c, i) + 1, ends_b.index(c, j) + 1
            groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
            i, j = i2, j2
        docs.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        count.update(set(links))
    most = collections.defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    return [(na, nb, g, len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), sha)
            for na, nb, g, links, sha in docs]


@pytest.fixture(scope="module")
def docs(spark):
    base = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    odd = [(10**6 + i, t) for i, t in enumerate(ODD)] + [(5, "again again")] * 2 + [(None, "x")]
    return base.unionByName(spark.createDataFrame(odd, "doc_id long, text string")).repartition(3).cache()


@pytest.mark.parametrize("most", [0, 300, 1 << 18])
def test_alignment_is_brute_force(spark, docs, most):
    wide = docs.selectExpr("*", "1 as n_a", "'z' as pairs", "7 as id", "8 as _row")
    rows = docs.collect()
    want = collections.Counter((r.doc_id, *w) for r, w in zip(rows, brute([r.text for r in rows])))
    got = AL.align(wide, broadcast_most=most)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert collections.Counter(map(tuple, got.collect())) == want


def test_empty_table(spark, docs):
    assert AL.align(docs.limit(0)).collect() == []


def test_long_text_without_spaces_is_one_text(spark):
    text = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(200_000))
    df = spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in AL.align(df).collect()}
    assert [got[1], got[2]] == brute([text, "short"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["the", "The", "ÉTÉ", "é", "é", "don't", "it's.", "'s", "...", "&&&", ".", ", ", " ", "\n", "\x1c",
                                          "\xa0", "×", "“", "ß!", "İ", "12", "3.5", "<|endoftext|>", "</s>", "ﬁ", "日本", "𝔘", "̀", "x‍",
                                          "-", "_", "'", "▁", "　", "\t"]), max_size=12).map("".join), min_size=1, max_size=4))
def test_batches_are_brute_force(texts):
    got = AL.encoder(AL.MODEL_A, AL.MODEL_B).aligned(pa.array(texts, pa.string()))
    for i, (na, nb, groups, links, *_, sha) in enumerate(brute(texts)):
        assert [got[c][i] for c in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")] == [na, nb, groups, links, sha]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60))), min_size=1, max_size=5))
def test_cuts_are_the_common_ends(spans):
    a, b, at, base = [], [], [0], 0
    for x, y in spans:
        a += [base + v for v in sorted(x | {61})]
        b += [base + v for v in sorted(y | {61})]
        at.append(len(a))
        base += 61
    a, b, at = np.array(a), np.array(b), np.array(at)
    near, common = AL.shared_cuts(a, b, at[:-1], at[1:])
    assert np.array_equal(common, np.isin(a, b)) and np.array_equal(near, np.searchsorted(b, a))


def test_a_full_cache_changes_nothing():
    texts = [" ".join(f"w{i * j % 97}x" for j in range(60)) for i in range(50)]
    small, large = AL.Encoder(AL.MODEL_A, AL.MODEL_B, most=40), AL.Encoder(AL.MODEL_A, AL.MODEL_B)
    for i in range(0, 50, 3):
        some = pa.array(texts[i:i + 3])
        assert all(np.array_equal(x, y) for x, y in zip(small(some), large(some)))
