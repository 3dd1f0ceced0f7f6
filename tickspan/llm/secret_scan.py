"""Secret scan: patterns of known kinds, and a token-efficiency test.

Candidates of the test are runs of token characters, cut at spans of a known
kind. Ordinary words and identifiers are held by a vocabulary in few
long pieces; a random string breaks into many short ones. A run of ``LEAST``
characters with fewer than ``ratio`` characters per piece is a span of kind
``random``. In other runs the parts between separators are tested, alone and
with their neighbours, so that key names and paths do not hide a value: the
stretches of parts with the most pieces for their length are spans, by ``ratio``
from ``LEAST`` letters and digits and by ``SHORT_RATIO`` from ``SHORT``. What is
a known digest (only hexadecimal digits, of a digest's length) or an identifier
(only digits and separators, a UUID, words and numbers joined by separators, if
the vocabulary holds the words in long pieces) is none. Upper-case hexadecimal
runs, whose digits the vocabulary pairs, have a ratio of their own.

Spans are in code points, end exclusive, ordered by start and then kind.

Defined results: a null or empty text has no spans; rows that repeat an id each
return a row; an empty table gives no rows; columns other than id and text are
ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F, types as T

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Random letters and digits have 1.2 to 1.6 characters per piece, the densest
#: real compound words about 1.9.
RATIO = 1.7
LEAST = 20
#: Short words of foreign languages and product names come near 1.6.
SHORT, SHORT_RATIO = 12, 1.4
#: Upper-case hexadecimal digits have about 1.8, and no words are made of them and digits.
HEX_LEAST, HEX_RATIO = 16, 2.4
KINDS = ("assign", "access", "hex", "random")

_ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_WORDS = ("passw", "secret", "token", "apikey", "api_key")   # one is in every match
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")          # the runs of [0-9a-f]+ with 16 characters or more
_RUN = re.compile(r"[A-Za-z0-9+/_=.!@#%%&*$^-]{%d,}" % SHORT)
_INNER = re.compile(r"[A-Za-z0-9]+")
_DIGEST = re.compile(r"(?:[0-9a-f]+|[0-9A-F]+)\Z")
_DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)   # MD5, SHA-1, SHA-2
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z")
_INNER_UUID = re.compile(r"(?<![0-9a-fA-F])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9a-fA-F])")
_NUMBER = re.compile(r"[0-9+/_=.!@#%&*$^-]+\Z")
_UPPER_HEX = re.compile(r"(?=[A-F]*[0-9])(?=[0-9]*[A-F])[0-9A-F]{%d,}\Z" % HEX_LEAST)
_PART = re.compile(r"[A-Za-z]{1,15}\Z|[0-9]{1,8}\Z")
_JOIN = re.compile(r"[+/_=.!@#%&*$^-]+")
#: Letters from which a part of an identifier must be a word.
WORD = 4


@functools.lru_cache(maxsize=2)
def load(vocabulary: str) -> tiktoken.Encoding:
    with open(public_tokenizers.path(vocabulary), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans ``start, kind, end`` of the known kinds."""
    low = text.lower()
    out = []
    if any(word in low for word in _WORDS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(1)) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def is_known(run: str, ratio: float, pieces_of) -> bool:
    """Digests and identifiers, which look random without being secret."""
    if _NUMBER.match(run) or _UUID.match(run):
        return True
    if len(run) in _DIGEST_LENGTHS and _DIGEST.match(run):
        return True
    parts = _JOIN.split(run)
    if len(parts) < 2 or not all(_PART.match(p) for p in parts if p):
        return False
    words = [p for p in parts if len(p) >= WORD and p.isalpha()]
    return sum(map(len, words)) >= ratio * sum(map(pieces_of, words))


def stretches(scores: list[float]) -> list[tuple[int, int]]:
    """First and last of the stretches with the highest positive sums, which do
    not overlap (all maximal scoring subsequences)."""
    out: list[tuple[int, int, float, float]] = []    # first, last, sum before, sum with it
    total = 0.0
    for i, x in enumerate(scores):
        before, total = total, total + x
        if x <= 0:
            continue
        first = i
        while out:
            # Those that start no lower cannot be joined to what follows.
            k = len(out) - 1
            while k >= 0 and out[k][2] >= before:
                k -= 1
            if k < 0 or out[k][3] >= total:
                break
            first, before = out[k][0], out[k][2]
            del out[k:]
        out.append((first, i, before, total))
    return [(a, b) for a, b, _, _ in out]


def free_runs(text: str, taken: list[tuple[int, int, int]]):
    """Runs of token characters without the spans taken."""
    at = 0                          # taken is sorted by start; what ends before a run is not looked at again
    for m in _RUN.finditer(text):
        a, b = m.span()
        while at < len(taken) and taken[at][2] <= a:
            at += 1
        k = at
        while k < len(taken) and taken[k][0] < b:
            s, _, e = taken[k]
            if s - a >= SHORT:
                yield a, s
            a, k = max(a, e), k + 1
        if b - a >= SHORT:
            yield a, b


def random_spans(text: str, vocabulary: str, ratio: float, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    found = list(free_runs(text, taken))
    if not found:
        return []
    encode = load(vocabulary).encode_ordinary

    def pieces_of(run):
        return sum(len(encode(run[i:i + 4096])) for i in range(0, len(run), 4096))
    out = []
    for a, b in found:
        a, b = a + len(text[a:b]) - len(text[a:b].lstrip(".")), a + len(text[a:b].rstrip("."))      # a sentence's end
        run = text[a:b]
        parts = [p.span() for p in _INNER.finditer(run)]
        if sum(e - s for s, e in parts) < SHORT:
            continue
        if b - a >= LEAST and b - a < ratio * pieces_of(run) and not is_known(run, ratio, pieces_of):
            out.append((a, 3, b))
            continue
        pieces = [pieces_of(run[s:e]) for s, e in parts]
        uuids = {u.start() + k for u in _INNER_UUID.finditer(run) for k in (0, 9, 14, 19, 24)}
        codes = [bool(_UPPER_HEX.match(run[s:e])) for s, e in parts]
        for i, j in stretches([-ratio * len(run) if s in uuids else (HEX_RATIO if c else ratio) * n - (e - s)
                               for n, c, (s, e) in zip(pieces, codes, parts)]):
            size, n = sum(e - s for s, e in parts[i:j + 1]), sum(pieces[i:j + 1])
            s, e = parts[i][0], parts[j][1]
            least, most = (HEX_LEAST, HEX_RATIO) if all(codes[i:j + 1]) else (LEAST, ratio)
            if (size < most * n if size >= least else SHORT <= size < SHORT_RATIO * n) and not is_known(run[s:e], ratio, pieces_of):
                out.append((a + s, 3, a + e))
    return out


def spans_of(text: str | None, vocabulary: str = VOCABULARY, ratio: float = RATIO):
    """The known kinds' spans, and all spans."""
    base = base_spans(text or "")
    return base, sorted(base + random_spans(text or "", vocabulary, ratio, base))


def written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
         ratio: float = RATIO) -> DataFrame:
    """One row per document: ``<id>, n_assign, n_access, n_hex, base_sha256,
    spans, n_random``."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    fields = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"
    kind = T.StructType([src.schema["id"], *T._parse_datatype_string(fields).fields])

    def run(batches):
        for b in batches:
            out = []
            for t in b.column("text").to_pylist():
                base, every = spans_of(t, vocabulary, ratio)
                n = [sum(k == i for _, k, _ in every) for i in range(4)]
                out.append((n[0], n[1], n[2], hashlib.sha256(written(base).encode()).hexdigest(), written(every), n[3]))
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), *(pa.array(cols[i], pa.string() if i in (3, 4) else pa.int64()) for i in range(6))],
                names=[f.name for f in kind])
    return src.mapInArrow(run, kind).withColumnRenamed("id", id_col)


def redacted(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars", mark: str = "[secret]",
             vocabulary: str = VOCABULARY, ratio: float = RATIO) -> DataFrame:
    """The documents with every span replaced by ``mark`` (overlapping spans by
    one) and ``chars_col``, if there, set to the new length. Texts without
    spans, and null texts, stay as they are."""
    def clean(text: str | None) -> str | None:
        if not text:
            return text
        out, end = [], 0
        for a, _, b in spans_of(text, vocabulary, ratio)[1]:
            if a >= end:
                out += [text[end:a], mark]
            end = max(end, b)
        return "".join(out) + text[end:] if out else text

    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            yield b.set_column(at, b.schema.field(at), pa.array([clean(t) for t in b.column(at).to_pylist()], b.schema.field(at).type))
        pa.default_memory_pool().release_unused()      # a worker that waits for its next task keeps no texts

    out = docs.mapInArrow(run, docs.schema)
    if chars_col and chars_col in docs.columns:
        kind = docs.schema[chars_col].dataType
        out = out.withColumn(chars_col, F.when(F.col(chars_col).isNotNull(), F.coalesce(
            F.char_length(text_col).cast(kind), F.col(chars_col))))
    return out
