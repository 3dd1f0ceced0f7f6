"""WARC archives: a writer of record-compressed files and a salvage reader.

Records are made in tasks and written by Spark's text writer, so archives go to
any storage Spark reaches, under its commit protocol. A gzip member ends with
the top byte of its length, which is zero below 16 MiB (larger records get an
empty member appended); the writer leaves that byte to the line separator, which
is set to a zero byte, so files are plain concatenated members.

Rows with equal payloads of at least ``least`` bytes are written once, as the
response of the largest id; the others are revisits that name it. Equal payloads
are found by digest with partial aggregates; their ids are joined back by
broadcast where they are counted to be few, else by a shuffle that adaptive
execution can split at a hot payload.

The reader steps through a file and through each member in blocks, whatever their
sizes: a task holds some blocks, at most 256 states of the inflation it may go back
to, and one record (without its payload if that is not wanted). Every record is
checked (version line, header, lengths, terminator, digests). After a failed
check it goes on where the record's own length ends it if a start follows there,
so records inside a damaged payload are no records; else at the next member or
version line that starts a valid record. The bytes between are logged as a gap.
The same is done within a member, and within what a damaged or truncated one
inflates to.
Rows from a valid member have its byte range; of a damaged one, the range up to
where each record was complete, and the rest is a gap; a record complete only
with the last byte of a cut file has both its fields and the gap's reason.

Defined results: a null html is an empty payload, a null url an empty target; a
null id revisits like any other and is the response only where all ids of the
payload are null; rows that tie on the largest id are each a response; an empty
table gives no records; columns other than id, url and html are ignored.
"""

from __future__ import annotations

import base64
import bisect
import codecs
import hashlib
import re
import urllib.parse
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickspan.session import cut_lineage

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 64 << 20
BROADCAST_PAYLOADS = 200_000
FILES = "{part-*,*.warc,*.warc.gz}"
_VERSION = re.compile(rb"WARC/\d{1,9}\.\d{1,9}\r\n")
_START = re.compile(rb"\x1f\x8b\x08|WARC/\d{1,9}\.\d{1,9}\r\n")
#: More than any match of these patterns takes.
LINE = 32
#: Files of up to this size come through Spark's reader, larger ones in blocks.
WHOLE_BYTES = 2 * FILE_BYTES
#: Bytes a task reads, inflates or hashes at a time, compressed bytes fed at a
#: time, blocks of a file held, inflated bytes held, states of a member kept.
CHUNK, PART, BLOCKS, HELD, MARKS = 1 << 20, 1 << 16, 16, 8 << 20, 256
BATCH_BYTES = 32 << 20
_EMPTY = zlib.compressobj(6, zlib.DEFLATED, 31).flush()


def sha1_32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def make_record(page, url: str | None, payload: bytes, keeper=None, date: str = DATE) -> bytes:
    """One uncompressed record; a revisit of page ``keeper`` if that is given."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if keeper is not None else http + payload
    target = urllib.parse.quote(url or "", safe="%/:?#[]@!$&'()*+,;=~")
    fields = [("WARC-Type", "response" if keeper is None else "revisit"), ("WARC-Record-ID", f"<urn:x-page:{page}>"),
              ("WARC-Date", date), ("WARC-Target-URI", target), ("WARC-Payload-Digest", "sha1:" + sha1_32(payload)),
              ("WARC-Block-Digest", "sha1:" + sha1_32(block))]
    if keeper is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:x-page:{keeper}>")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def member(record: bytes) -> bytes:
    """A gzip member (or two) whose last byte is zero."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = z.compress(record) + z.flush()
    return out if out[-1] == 0 else out + _EMPTY


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          least: int = 0, file_bytes: int = FILE_BYTES) -> None:
    """Write one record per row below ``path``."""
    src = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                       F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8").alias("payload"))
    src = src.withColumn("sha", F.sha1("payload")).withColumn("size", F.length("payload"))
    same = cut_lineage(src.where(F.col("size") >= least).groupBy("sha", "size").agg(
        F.max("id").alias("keeper"), F.count("*").alias("n")).where("n > 1 and keeper is not null").drop("n"))
    total = src.agg(F.sum("size")).first()[0] or 0
    if same.count() <= BROADCAST_PAYLOADS:
        same = F.broadcast(same)
    told = src.join(same, ["sha", "size"], "left").withColumn(
        "keeper", F.when(~F.col("keeper").eqNullSafe(F.col("id")), F.col("keeper")))
    n_files = max(1, -(-int(total) // file_bytes))
    spread = told.repartition(n_files, F.xxhash64("id", "sha")).select("id", "url", "payload", "keeper")

    def run(batches):
        for b in batches:
            out = [member(make_record(i, u, p, k))[:-1] for i, u, p, k in zip(*(c.to_pylist() for c in b.columns))]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    (spread.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", "\0").text(path))


class Bad(Exception):
    """A failed check; the message is the reason that the gap logs. ``stop`` is
    where the record ends by its own length, if its terminator is there."""

    def __init__(self, why: str, stop: int | None = None):
        super().__init__(why)
        self.stop = stop


class Bytes:
    """``size`` bytes that are read in parts, mostly forwards."""

    size = 0

    def get(self, at: int, n: int) -> bytes:
        """``n`` bytes from ``at``, fewer only at the end."""
        raise NotImplementedError

    def _parts(self, at: int, stop: int, overlap: int):
        step = 4096
        while at < stop:
            part = self.get(at, min(step, stop - at))
            yield at, part
            if not part or at + len(part) >= stop:
                return
            at, step = at + len(part) - overlap, min(2 * step, CHUNK)

    def find(self, what: bytes, at: int, stop: int | None = None) -> int:
        for at, part in self._parts(at, self.size if stop is None else stop, len(what) - 1):
            hit = part.find(what)
            if hit >= 0:
                return at + hit
        return -1

    def following(self, pattern: re.Pattern, at: int) -> int:
        """Where the next match (of at most ``LINE`` bytes) starts, or the end."""
        for at, part in self._parts(at, self.size, LINE - 1):
            hit = pattern.search(part)
            if hit:
                return at + hit.start()
        return self.size


class Whole(Bytes):
    def __init__(self, data: bytes):
        self.data, self.size = data, len(data)

    def get(self, at: int, n: int) -> bytes:
        return self.data[at:at + n]


class Opened(Bytes):
    """A file that can seek, of which the last few blocks read are held."""

    def __init__(self, file, size: int):
        self.file, self.size, self.blocks = file, size, {}

    def _block(self, k: int) -> bytes:
        block = self.blocks.pop(k, None)
        if block is None:
            self.file.seek(k * CHUNK)
            block = self.file.read(CHUNK)
        self.blocks[k] = block
        if len(self.blocks) > BLOCKS:
            del self.blocks[next(iter(self.blocks))]
        return block

    def get(self, at: int, n: int) -> bytes:
        end = min(at + n, self.size)
        return b"".join(self._block(k)[max(at - k * CHUNK, 0):end - k * CHUNK]
                        for k in range(at // CHUNK, -(-end // CHUNK))) if at < end else b""


class Inflated(Bytes):
    """What the gzip member at ``start`` inflates to. It is inflated once to learn
    its size, where it ends (``end``) and what is wrong with it (``bad``); the
    last ``HELD`` bytes are held, and earlier ones are inflated again from the
    nearest of at most ``MARKS`` states kept on the way."""

    def __init__(self, outer: Bytes, start: int):
        self.outer, self.bad = outer, None
        self.marks, self.apart = [(0, start, None)], CHUNK
        self._restore(self.marks[0])
        while self._more():
            self._mark()
            self._trim(self.at + len(self.held))
        self.size = self.at + len(self.held)
        self.end = self.fed - len(self.rest) - len(self.z.unused_data)

    def _restore(self, mark):
        self.at, self.fed, z = mark
        self.z = z.copy() if z else zlib.decompressobj(31)
        self.rest, self.step, self.held = b"", 4096, bytearray()

    def _more(self) -> bool:
        """Inflates a part. One that fails is fed again by bytes, to keep what it holds."""
        while not self.z.eof and self.bad is None or self.at + len(self.held) < self.size:
            if not self.rest:
                self.rest = self.outer.get(self.fed, self.step)
                self.fed += len(self.rest)
                self.step = 1 if self.step == 1 else min(2 * self.step, PART)
            given, before = self.rest, None if self.step == 1 else self.z.copy()
            try:
                out = self.z.decompress(given, CHUNK)
            except zlib.error as e:
                if self.step == 1:
                    self.bad = "gzip: " + str(e).rpartition(": ")[2]
                    return False
                self.z, self.rest, self.step = before, b"", 1
                self.fed -= len(given)
                continue
            self.rest = b"" if self.z.eof else self.z.unconsumed_tail
            if out:
                self.held += out
                return True
            if not given and not self.z.eof:
                self.bad = "gzip: cut short"
                return False
        return False

    def _mark(self):
        made = self.at + len(self.held)
        if made - self.marks[-1][0] >= self.apart and self.step > 1:
            self.marks.append((made, self.fed - len(self.rest), self.z.copy()))
            if len(self.marks) > MARKS:
                self.marks, self.apart = self.marks[::2], 2 * self.apart

    def _trim(self, wanted: int):
        drop = min(len(self.held) - HELD, wanted - self.at)
        if drop > HELD:
            del self.held[:drop]
            self.at += drop

    def get(self, at: int, n: int) -> bytes:
        end = min(at + n, self.size)
        if at >= end:
            return b""
        if not self.at <= at <= self.at + len(self.held):
            near = self.marks[bisect.bisect_right(self.marks, at, key=lambda m: m[0]) - 1]
            if at < self.at or near[0] > self.at + len(self.held):
                self._restore(near)
        while self.at + len(self.held) < end and self._more():
            self._trim(at)
        return bytes(self.held[at - self.at:end - self.at])


class Ends:
    """Where the member at ``start`` has inflated to given numbers of bytes, in ascending order."""

    def __init__(self, outer: Bytes, start: int):
        self.outer, self.at, self.made, self.step, self.z = outer, start, 0, PART, zlib.decompressobj(31)

    def upto(self, end: int) -> int:
        while self.made < end:
            part, before = self.outer.get(self.at, self.step), self.z.copy()
            if not part:
                break
            try:
                self.made += len(self.z.decompress(part, min(end - self.made, CHUNK)))
            except zlib.error:
                if self.step == 1:
                    break
                self.z, self.step = before, 1
                continue
            self.at += len(part) - len(self.z.unconsumed_tail)
        return self.at


def text_of(data: Bytes, at: int, end: int) -> str:
    """Decoded by parts, so that bytes which are no text are not gathered."""
    decode = codecs.getincrementaldecoder("utf-8")().decode
    return "".join(decode(data.get(a, min(CHUNK, end - a)), a + CHUNK >= end) for a in range(at, end, CHUNK))


def header_of(data: Bytes, at: int) -> tuple[dict, int]:
    """The fields of the record at ``at``, folded lines joined, and where its block starts."""
    version = _VERSION.match(data.get(at, LINE))
    if not version:
        raise Bad("no version line")
    at += version.end()
    fields, name = {}, None
    while True:
        end = data.find(b"\r\n", at)
        if end < 0:
            raise Bad("no end of header")
        try:
            line = text_of(data, at, end)
        except UnicodeDecodeError:
            raise Bad("header is no text") from None
        at = end + 2
        if not line:
            return fields, at
        if line[0] in " \t" and name is not None:
            fields[name] = (fields[name] + " " + line.strip()).strip()
            continue
        name, colon, value = line.partition(":")
        if not colon:
            raise Bad("bad header line")
        name = name.strip().lower()
        fields[name] = value.strip()


def parse_record(data: Bytes, at: int, with_payload: bool = True) -> tuple[dict, int]:
    """The record at ``at`` and where it ends."""
    fields, start = header_of(data, at)
    length = fields.get("content-length", "")
    if not re.fullmatch("[0-9]{1,18}", length):
        raise Bad("no content length")
    stop = start + int(length)
    if data.get(stop, 4) != b"\r\n\r\n":
        raise Bad("no terminator")
    kind, body = fields.get("warc-type", ""), start
    if "http" in fields.get("content-type", ""):
        gap = data.find(b"\r\n\r\n", start, stop)
        body = stop if gap < 0 else gap + 4
    block, payload, parts = hashlib.sha1(), hashlib.sha1(), []
    for a in range(start, stop, CHUNK):
        part = data.get(a, min(CHUNK, stop - a))
        block.update(part)
        part = part[max(0, body - a):]
        payload.update(part)
        if with_payload:
            parts.append(part)
    made = base64.b32encode(payload.digest()).decode()
    said = fields.get("warc-block-digest", "")
    if said.startswith("sha1:") and said[5:] != base64.b32encode(block.digest()).decode():
        raise Bad("block digest", stop + 4)
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind != "revisit" and digest and digest != made:
        raise Bad("payload digest", stop + 4)
    size = stop - body
    if kind == "revisit":
        named = re.search(rb"(?i)content-length:\s*([0-9]{1,18})", data.get(start, body - start))
        size = int(named.group(1)) if named else size
    return {"type": kind, "record_id": fields.get("warc-record-id"), "target_uri": fields.get("warc-target-uri"),
            "refers_to_id": fields.get("warc-refers-to"), "payload_digest": digest or made,
            "payload_bytes": size, "payload": b"".join(parts) if with_payload else None}, stop + 4


def resumed(data: Bytes, at: int, bad: Bad, starts: re.Pattern) -> int:
    """Where to go on after a bad record at ``at``: where its own length ends it,
    if something starts (or all ends) there, so that nothing in its payload is
    taken for a record; else at the next start."""
    if bad.stop is not None and (bad.stop >= data.size or starts.match(data.get(bad.stop, LINE))):
        return bad.stop
    return data.following(starts, at + 1)


def records(data: Bytes, with_payload: bool = True):
    """Yields ``(end, record or None, reason)`` within a member: records, and
    gaps up to where the next one starts."""
    at, why = 0, None
    while at < data.size:
        try:
            record, end = parse_record(data, at, with_payload)
        except Bad as e:
            why = why or str(e)
            at = resumed(data, at, e, _VERSION)
            continue
        if why is not None:
            yield at, None, why
            why = None
        yield end, record, None
        at = end
    if why is not None:
        yield at, None, why


def salvage(data: Bytes | bytes, with_payload: bool = True):
    """Yields ``(start, end, record or None, reason)`` for a whole archive:
    records of members and plain records, and gaps, as they are found."""
    if not isinstance(data, Bytes):
        data = Whole(data)
    at, gap, why = 0, None, None
    while at < data.size:
        if data.get(at, 2) == b"\x1f\x8b":
            inner, ends, some = Inflated(data, at), Ends(data, at), False
            if inner.bad is None:
                if gap is not None:
                    yield gap, at, None, why
                    gap = None
                for _, record, reason in records(inner, with_payload):
                    yield at, inner.end, record, reason
                at = inner.end
                continue
            bad = Bad(inner.bad)
            for end, record, _ in records(inner, with_payload):
                if record is None:
                    continue
                if gap is not None:
                    yield gap, at, None, why
                    gap = None
                end, some = ends.upto(end), True
                yield at, end, record, inner.bad if end == data.size else None    # no bytes left for a gap
                at = end
            if some:
                if at < data.size:
                    gap, why = at, inner.bad
                    at = data.following(_START, at)
                continue
        else:
            try:
                record, end = parse_record(data, at, with_payload)
            except Bad as e:
                bad = e
            else:
                if gap is not None:
                    yield gap, at, None, why
                    gap = None
                yield at, end, record, None
                at = end
                continue
        if gap is None:
            gap, why = at, str(bad)
        at = resumed(data, at, bad, _START)
    if gap is not None:
        yield gap, data.size, None, why


SCHEMA = ("file string, start long, end long, gap string, type string, record_id string, target_uri string, "
          "refers_to_id string, payload_digest string, payload_bytes long, payload binary")


def open_file(path: str):
    """A seekable file at a local or mounted path, or in a store that Arrow reads."""
    if path.startswith("file:") or "://" not in path:
        return open(re.sub("^file:/+", "/", path), "rb")
    filesystem, name = fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))
    return filesystem.open_input_file(name)


def read(spark: SparkSession, path: str, with_payload: bool = True, names_like: str = FILES,
         whole_bytes: int = WHOLE_BYTES, opener=open_file) -> DataFrame:
    """Rows of the files whose names fit the glob ``names_like``, as ``SCHEMA``: records (``gap`` null) and quarantined gaps, which
    have the reason there and only the file and byte range besides.

    Files of up to ``whole_bytes`` come through Spark's own reader; for larger
    ones only names and sizes do, and tasks read them in blocks from what
    ``opener`` makes of the name."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def rows_of(file, data):
        rows, held = [], 0
        for start, end, record, why in salvage(data, with_payload):
            rows.append({"file": file, "start": start, "end": end, "gap": why, **(record or {})})
            held += len(rows[-1].get("payload") or b"")
            if len(rows) >= 1000 or held > BATCH_BYTES:
                yield batch(rows)
                rows, held = [], 0
        if rows:
            yield batch(rows)

    def run_whole(batches):
        for b in batches:
            for i in range(b.num_rows):
                yield from rows_of(b.column(0)[i].as_py(), Whole(b.column(1)[i].as_py() or b""))

    def run_opened(batches):
        for b in batches:
            for name, size in zip(*(c.to_pylist() for c in b.columns)):
                with opener(name) as file:
                    yield from rows_of(name, Opened(file, size))

    def batch(rows):
        kinds = {"start": pa.int64(), "end": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kinds.get(n, pa.string())) for n in names],
                                          names=names)
    files = spark.read.format("binaryFile").option("pathGlobFilter", names_like).load(path)
    small = files.where(F.col("length") <= whole_bytes).select("path", "content").mapInArrow(run_whole, SCHEMA)
    large = files.where(F.col("length") > whole_bytes).select("path", "length").mapInArrow(run_opened, SCHEMA)
    return small.unionByName(large)


def intact(rows: DataFrame) -> DataFrame:
    """The rows of ``read``, which fails where there is a gap."""
    said = F.concat(F.lit("gap in "), "file", F.lit(" at "), F.col("start").cast("string"), F.lit(": "), "gap")
    return rows.where(F.when(F.col("gap").isNull(), True).otherwise(F.raise_error(said).cast("boolean")))


def page_of(uri):
    return F.regexp_extract(uri, r"^<urn:x-page:(-?[0-9]+)>$", 1).try_cast("long")
