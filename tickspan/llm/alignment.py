"""Cross-tokenizer alignment: divide and conquer at shared cuts.

The tokens of two tokenizers over the same bytes end at offsets. Within an
interval the common end nearest the middle is sought: ends of the first
tokenizer are tried outwards from the middle, each looked up among the second's
by bisection. At a common end the interval is cut and both halves are treated
alike; ends tried without success are never tried again, so every end is looked
up once. An interval without a common end inside is a leaf: a group of tokens of
either side that cover the same bytes. All intervals of a batch of texts take
their steps together, in arrays.

Two tokens are linked where their byte ranges overlap. How many documents hold
an id pair linked is counted over all documents; the most frequent pairs, bounded
in number, are broadcast, and what is left of each document is joined to the other
pairs by shuffle, so no frequent pair is a hot key. The split changes no result.

Texts are split at spaces that follow something else, where neither tokenizer
joins; a batch's distinct words are encoded once. Texts with other white space
before a space, or a space at either end, are encoded whole.

Defined results: null and empty texts, and texts whose tokens do not give back
their bytes, have no tokens; rows that repeat an id are documents each; an empty
table gives no rows; columns other than id and text are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Tokenizer

from tickspan.llm import token_count
from tickspan.llm.common import stored

MODEL_A, MODEL_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: White space (of any library) before a space, or a space at an end.
ODD = "(?:^ )|(?: $)|[\t\n\x0b\f\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000] "


def byte_of_char() -> dict[str, int]:
    """What the characters of byte-level pieces stand for: printable ones for
    themselves, the rest are numbered on from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


@functools.lru_cache(maxsize=2)
def byte_level(model: str) -> tuple[Tokenizer, list[bytes]]:
    """A byte-level tokenizer that takes special strings as text, and its pieces' bytes by id."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")     # tasks are the parallelism
    tok = Tokenizer.from_file(public_tokenizers.path(model))
    tok.encode_special_tokens = True
    of, vocab = byte_of_char(), tok.get_vocab(with_added_tokens=True)
    pieces = [b""] * (max(vocab.values()) + 1)
    for piece, i in vocab.items():
        pieces[i] = bytes(of[c] for c in piece) if all(c in of for c in piece) else piece.encode()
    return tok, pieces


@functools.lru_cache(maxsize=2)
def by_piece(model: str) -> tuple[sentencepiece.SentencePieceProcessor, list[bytes]]:
    sp, _ = token_count.load(model)           # refuses vocabularies that join across spaces
    byte = re.compile("<0x([0-9A-F]{2})>")
    pieces = []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        code = byte.fullmatch(piece) if sp.is_byte(i) else None
        pieces.append(bytes([int(code[1], 16)]) if code else piece.replace(token_count.MARK, " ").encode())
    return sp, pieces


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every end of A, where bisection puts it among B's ends, and whether
    it is common. ``starts, stops``: the whole intervals to divide, as positions
    of A's ends; the last end of each is known to be common."""
    near = np.searchsorted(ends_b, ends_a)
    common = np.zeros(len(ends_a), bool)
    common[stops - 1] = True
    lo, hi = starts.copy(), stops - 1                     # untried ends of each interval: lo <= i < hi
    lo, hi = lo[starts < stops - 1], hi[starts < stops - 1]
    mid = (lo + hi) >> 1
    left, right = mid, mid                                # tried: left < i < right (none yet)
    while len(lo):
        # The next end outwards, on the side that is nearer the middle (or on the one that is left).
        up = (right < hi) & ((right - mid <= mid - left) | (left <= lo))
        at = np.where(up, right, left - 1)
        hit = ends_b[near[at]] == ends_a[at]
        common[at[hit]] = True
        left, right = np.where(up, left, at), np.where(up, at + 1, right)
        # A cut leaves two halves, each without what has been tried.
        new_lo = np.concatenate((lo[hit], right[hit]))
        new_hi = np.concatenate((left[hit], hi[hit]))
        some = new_lo < new_hi
        new_lo, new_hi = new_lo[some], new_hi[some]
        on = ~hit & ((left > lo) | (right < hi))
        new_mid = (new_lo + new_hi) >> 1
        lo, hi = np.concatenate((lo[on], new_lo)), np.concatenate((hi[on], new_hi))
        mid = np.concatenate((mid[on], new_mid))
        left, right = np.concatenate((left[on], new_mid)), np.concatenate((right[on], new_mid))
    return near, common


class Encoder:
    """Ids of both tokenizers for whole texts, from a bounded cache of words:
    two generations of ``most`` words; a full one becomes the old one."""

    def __init__(self, model_a: str, model_b: str, most: int = 300_000):
        self.a, self.bytes_a = byte_level(model_a)
        self.b, self.bytes_b = by_piece(model_b)
        self.len_a = np.array([len(x) for x in self.bytes_a])
        self.len_b = np.array([len(x) for x in self.bytes_b])
        self.most, self.known, self.old = most, {}, {}
        self.decimals = pa.array([f"{i}{mark}".encode() for i in range(max(len(self.bytes_a), len(self.bytes_b)))
                                  for mark in ",|;"], pa.binary())

    def encoded(self, texts: list[str]) -> list[tuple[bytes, bytes, bool]]:
        """Ids of both, four bytes each, and whether they give back the bytes."""
        out = []
        for part in range(0, len(texts), 2000):
            some = texts[part:part + 2000]
            of_a = self.a.encode_batch_fast([" " + t for t in some], add_special_tokens=False)
            for t, a, b in zip(some, of_a, self.b.encode(some, num_threads=1)):
                want, ids = b" " + t.encode(), a.ids
                same = (b"".join(map(self.bytes_a.__getitem__, ids)) == want == b"".join(map(self.bytes_b.__getitem__, b)))
                out.append((np.array(ids, "<i4").tobytes(), np.array(b, "<i4").tobytes(), same))
        return out

    def spelled(self, words: list[str]) -> list[tuple[bytes, bytes, bool]]:
        """As ``encoded``, for words: those that white space cannot join are
        encoded as one text and cut where tokens of both end with a word."""
        out = {w: None for w in words if w and w == w.strip()}
        every = list(out)
        for part in range(0, len(every), 2000):
            some = every[part:part + 2000]
            text = " ".join(some)
            want = (" " + text).encode()
            ends = np.cumsum(np.fromiter((len(w.encode()) + 1 for w in some), np.int64, len(some)))
            cut = []
            for ids, pieces, sizes in ((self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, self.bytes_a, self.len_a),
                                       (self.b.encode(text), self.bytes_b, self.len_b)):
                if b"".join(map(pieces.__getitem__, ids)) != want:
                    break
                flat = np.array(ids, "<i4")
                at = np.cumsum(sizes[flat])
                last = np.searchsorted(at, ends)
                if (at[last] != ends).any():
                    break
                data, edges = flat.tobytes(), ((last + 1) * 4).tolist()
                cut.append(map(data.__getitem__, map(slice, [0, *edges], edges)))
            if len(cut) == 2:
                out.update((w, (x, y, True)) for w, x, y in zip(some, *cut))
        rest = [w for w in words if out.get(w) is None]
        out.update(zip(rest, self.encoded(rest)))
        return [out[w] for w in words]

    def lookup(self, words: list[str]) -> list[tuple[bytes, bytes, bool]]:
        missing = [w for w in words if w not in self.known]
        if len(self.known) + len(missing) > self.most:
            self.old, self.known = self.known, {}
            missing = words
        new = [w for w in missing if w not in self.old]
        self.known.update((w, self.old[w]) for w in missing if w in self.old)
        self.known.update(zip(new, self.spelled(new)))
        return [self.known[w] for w in words]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and starts of A, then of B; texts that do not give back their bytes have none."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, ODD)
        split = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        words = split.flatten().dictionary_encode()
        known = self.lookup(words.dictionary.to_pylist())
        fine = np.array([k[2] for k in known], bool)[words.indices.to_numpy()] if known else np.zeros(0, bool)
        at = split.offsets.to_numpy()
        at = at - at[0]
        wrong = np.concatenate(([0], np.cumsum(~fine)))
        drop = (wrong[at[1:]] > wrong[at[:-1]]) | pc.equal(texts, "").to_numpy(zero_copy_only=False)
        # A text with words that do not give back theirs never gives back its own.
        whole = {int(i): e for i, e in zip(np.flatnonzero(odd), self.encoded(texts.filter(odd).to_pylist()))}
        out = []
        for side in (0, 1):
            pieces = [k[side] for k in known]
            ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces))) // 4
            each = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()),
                                            pa.array(np.frombuffer(b"".join(pieces), "<i4")))
            ids = each.take(words.indices)
            flat, starts = ids.flatten().to_numpy(zero_copy_only=False), ids.offsets.to_numpy()[at].astype(np.int64)
            if drop.any() or whole:
                rows = [np.frombuffer(whole[i][side], "<i4") if i in whole and whole[i][2] else flat[:0] if i in whole or drop[i]
                        else flat[starts[i]:starts[i + 1]] for i in range(len(drop))]
                flat = np.concatenate(rows)
                starts = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
            out += [flat, starts]
        return tuple(out)

    def aligned(self, texts: pa.Array) -> dict:
        """Per text: counts, digest of the groups, and its distinct linked pairs
        (A's id and B's) with how often they are linked."""
        a, at_a, b, at_b = self(texts)
        n = len(texts)
        ends_a, ends_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])      # both cover the same bytes, text after text
        full = at_a[1:] > at_a[:-1]
        near, common = shared_cuts(ends_a, ends_b, at_a[:-1][full], at_a[1:][full])
        cut_a, cut_b = np.flatnonzero(common) + 1, near[common] + 1              # where groups end
        text_a, text_b = np.repeat(np.arange(n), np.diff(at_a)), np.repeat(np.arange(n), np.diff(at_b))
        n_groups = np.bincount(text_a[common], minlength=n)
        # Groups in turn, A's tokens before B's, each with the mark that follows it.
        mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        mark_a[cut_a - 1], mark_b[cut_b - 1] = 1, 2
        sizes_a, sizes_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.repeat(cut_b - sizes_b, sizes_a)] = a * 3 + mark_a
        order[np.arange(len(b)) + np.repeat(cut_a, sizes_b)] = b * 3 + mark_b
        shown = self.decimals.take(pa.array(order))
        spans = shown.cast(pa.large_binary())
        offsets = np.frombuffer(spans.buffers()[1], np.int64, len(order) + 1)[at_a + at_b]
        data = memoryview(spans.buffers()[2] or b"")
        digests = [hashlib.sha256(data[s:e - 1]).hexdigest() if e > s else "" for s, e in zip(offsets.tolist(), offsets[1:].tolist())]
        # A link for each end: an A end with the B token it falls in, a B end inside an A token with that.
        inside = np.ones(len(b), bool)
        inside[cut_b - 1] = False
        over = np.searchsorted(ends_a, ends_b[inside])
        of_a, of_b = np.concatenate((a, a[over])).astype(np.int64), np.concatenate((b[near], b[inside]))
        text = np.concatenate((text_a, text_b[inside]))
        shift_b, shift_t = len(self.bytes_b).bit_length(), (len(self.bytes_a) + 1).bit_length() + len(self.bytes_b).bit_length()
        pair = of_a << shift_b | of_b
        codes, times = np.unique(text << shift_t | pair, return_counts=True)
        held = np.searchsorted(codes >> shift_t, np.arange(n + 1))
        return {"n_a": np.diff(at_a), "n_b": np.diff(at_b), "n_groups": n_groups, "n_links": np.bincount(text, minlength=n),
                "groups_sha256": digests, "pairs": codes & ((1 << shift_t) - 1), "times": times, "held": held}


@functools.lru_cache(maxsize=2)
def encoder(model_a: str, model_b: str) -> Encoder:
    return Encoder(model_a, model_b)


def alignments(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_a: str = MODEL_A,
               model_b: str = MODEL_B) -> DataFrame:
    """Stored rows ``id, n_a, n_b, n_groups, n_links, groups_sha256, pairs,
    times, _row``: a pair is A's id shifted over B's."""
    held_type = pa.list_(pa.int64())

    def run(batches):
        enc = encoder(model_a, model_b)
        for whole in batches:
            # Parts of about 4 MB, or one longer text.
            part = np.cumsum(pc.fill_null(pc.binary_length(whole.column("text")), 0).to_numpy()) >> 22
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), whole.num_rows]
            for at, end in zip(cuts, cuts[1:]):
                if at == end:
                    continue
                some = whole.slice(at, end - at)
                got = enc.aligned(some.column("text"))
                held = pa.array(got["held"], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [some.column("id"), *(pa.array(got[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")),
                     pa.array(got["groups_sha256"], pa.string()),
                     *(pa.ListArray.from_arrays(held, pa.array(got[c], pa.int64()), type=held_type) for c in ("pairs", "times"))],
                    names=["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = T.StructType([src.schema["id"], *T._parse_datatype_string(
        "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>").fields])
    return stored(src.mapInArrow(run, kind).withColumn("_row", F.monotonically_increasing_id()), "aligned")


def pair_counts(rows: DataFrame, model_b: str = MODEL_B) -> DataFrame:
    """Stored rows ``pair, n, best``: documents that hold the pair linked, and
    whether no other pair of its A id is held by more."""
    shift = len(by_piece(model_b)[1]).bit_length()
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    counts = stored(counts.withColumn("a", F.shiftright("pair", shift)), "pair-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return stored(counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


def frequent(counts: DataFrame, most: int) -> int:
    """The least count at which no more than ``most`` pairs are left."""
    step = F.floor(F.log2("n") * 8)
    least, total = 1 << 62, 0
    for r in counts.groupBy(step.alias("s")).agg(F.count("*").alias("k"), F.min("n").alias("n")).orderBy(F.desc("s")).collect():
        if total + r["k"] > most:     # at most eight steps for each doubling: a few hundred rows
            break
        least, total = r["n"], total + r["k"]
    return least


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_a: str = MODEL_A, model_b: str = MODEL_B,
          broadcast_most: int = 1 << 18) -> DataFrame:
    """One row per document: ``<id>, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256``."""
    rows = alignments(docs, id_col, text_col, model_a, model_b)
    counts = pair_counts(rows, model_b)
    least = frequent(counts, broadcast_most)
    often = F.broadcast(counts.where(F.col("n") >= least))
    links = rows.select("_row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("times"))))
    best, total = F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)), F.sum(F.col("n") * F.col("times"))
    near = links.join(often, "pair").groupBy("_row").agg(best.alias("n_best"), total.alias("count_sum"))
    rest = (links.join(often, "pair", "left_anti").join(counts.where(F.col("n") < least).hint("shuffle_merge"), "pair")
            .groupBy("_row").agg(best.alias("n_best"), total.alias("count_sum")))
    sums = near.unionByName(rest).groupBy("_row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return rows.drop("pairs", "times").join(sums, "_row", "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
