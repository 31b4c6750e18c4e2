"""Zstandard web archives: one frame per record, a shared dictionary in the leading skippable frame.

``write_archives`` turns rows into archive files, ``read_archives`` turns files
back into rows. Both stream: a task holds one record at a time beside its Arrow
batch. Archives lie in a shared folder; a task writes under a name of its own
and only names of finished tasks reach the manifest, so a repeated task leaves
at most a file that nobody reads.

Defined cases: a null payload is an empty one; a null uri has no target header;
a null id is written as ``null`` and read back as null; rows with the same id
and payload are all responses when that id is the smallest; an empty table
gives no archive. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.llm.common import in_batches, sampled, written
from tallyspan.session import new_shared_path

# Fixed values of the formats: frame magics (little endian) and names.
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE_FRAMES = range(0x184D2A50, 0x184D2A60)
ZSTD_FRAME = 0xFD2FB528
VERSION = b"WARC/1.1"
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ID_PREFIX = "urn:record:"
SALTS = 16
CHUNK = 1 << 18
RECORD_SCHEMA = (
    "record_id string, record_type string, refers_to string, target_uri string, "
    "payload_bytes long, payload_digest string, payload binary, problem string"
)


class BadArchive(ValueError):
    """An archive or record that breaks the format."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- records -------------------------------------------------------------------


def record_bytes(kind: str, record_id: str, uri: str | None, payload: bytes, size: int, sha1: str, refers_to: str | None, date: str) -> bytes:
    """One record. A revisit keeps the HTTP head, whose length field tells the payload's size, and drops the payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head + payload if kind == "response" else head
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date)]
    if uri is not None:
        fields.append(("WARC-Target-URI", uri.replace("\r", "%0D").replace("\n", "%0A")))
    fields.append(("WARC-Payload-Digest", f"sha1:{sha1}"))
    fields.append(("WARC-Block-Digest", f"sha1:{digest(block)}"))
    if kind == "revisit":
        fields += [("WARC-Refers-To", f"<{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8", "surrogatepass")
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def _text(raw: bytes) -> str:
    """A header's text: UTF-8 or, as older archives have it, Latin-1."""
    try:
        return raw.decode("utf-8", "surrogatepass")
    except UnicodeDecodeError:
        return raw.decode("latin-1")


def _fields(lines: bytes) -> dict[str, str]:
    """Header fields by lower-case name; a line that begins with a blank goes on with the one before."""
    out: dict[str, str] = {}
    last = None
    for line in lines.split(b"\r\n"):
        if line[:1] in (b" ", b"\t") and last:
            out[last] = f"{out[last]} {_text(line.strip())}".strip()
            continue
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise BadArchive(f"bad header line {line[:80]!r}")
        last = name.decode("latin-1").lower()
        out[last] = _text(value.strip())
    return out


def _matches(said: str, data: bytes) -> bool:
    """Whether a labelled digest is that of the data; one in an unknown algorithm or form cannot be checked and passes."""
    label, colon, value = said.partition(":")
    label = label.lower().replace("-", "")
    if not colon or not value or label not in ("md5", "sha1", "sha256", "sha512"):
        return True
    found = hashlib.new(label, data).digest()
    forms = {base64.b32encode(found).decode().rstrip("="), found.hex().upper()}
    return len(value.rstrip("=")) not in map(len, forms) or value.rstrip("=").upper() in forms


def _sha1_of(said: str) -> str | None:
    """The base 32 SHA-1 that a header states, if it does."""
    label, _, value = said.partition(":")
    return value.upper() if label.lower() in ("sha1", "sha-1") and len(value) == 32 else None


def _unchunked(body: bytes) -> bytes | None:
    """The content of a chunked body, None where it is none."""
    out, at = [], 0
    while True:
        line, gap, _ = body[at : at + 40].partition(b"\r\n")
        try:
            size = int(line.partition(b";")[0], 16)
        except ValueError:
            return None
        at += len(line) + 2
        if not gap or size < 0 or len(body) < at + size:
            return None
        if not size:
            return b"".join(out)
        out.append(body[at : at + size])
        at += size + 2


def parse_record(data: bytes) -> tuple:
    """The fields of RECORD_SCHEMA but the last. Raises BadArchive where a header, a length or a digest is wrong.

    Other writers' records are read as the standard allows: folded and Latin-1
    headers, digests of other algorithms (checked where they can be), HTTP
    without a length or in chunks, whose content is the payload, and revisits
    that name no record; a size that nothing states is null.
    """
    top, gap, rest = data.partition(b"\r\n\r\n")
    version, _, lines = top.partition(b"\r\n")
    if not gap or version not in (VERSION, b"WARC/1.0"):
        raise BadArchive(f"no record header: {version[:20]!r}")
    field = _fields(lines)
    for name in REQUIRED:
        if name.lower() not in field:
            raise BadArchive(f"{name} is missing")
    length = field["content-length"]
    if not (length.isascii() and length.isdigit()):
        raise BadArchive(f"Content-Length is {length!r}")
    if len(rest) != int(length) + 4 or not rest.endswith(b"\r\n\r\n"):
        raise BadArchive(f"Content-Length is {length}, the frame holds {len(rest) - 4}")
    block, kind = rest[:-4], field["warc-type"]
    if not _matches(field.get("warc-block-digest", ""), block):
        raise BadArchive("block digest differs")
    refers_to = field["warc-refers-to"].strip("<>") if "warc-refers-to" in field else None
    base = (field["warc-record-id"].strip("<>"), kind, refers_to, field.get("warc-target-uri"))
    said = field.get("warc-payload-digest", "")
    if kind not in ("response", "revisit"):
        return *base, len(block), _sha1_of(said), block
    if not block.startswith(b"HTTP/"):  # the answer of another protocol is its own payload
        if kind == "response" and not _matches(said, block):
            raise BadArchive("payload digest differs")
        return (*base, None, _sha1_of(said), None) if kind == "revisit" else (*base, len(block), _sha1_of(said) or digest(block), block)
    http, gap, payload = block.partition(b"\r\n\r\n")
    answer = _fields(http.partition(b"\r\n")[2]) if gap and b"\r\n" in http else {}
    size = answer.get("content-length", "")
    stated = int(size) if size.isascii() and size.isdigit() else None
    if kind == "revisit":
        if payload:
            raise BadArchive("a revisit holds a payload")
        return *base, stated, _sha1_of(said), None
    whole = _unchunked(payload) if "chunked" in answer.get("transfer-encoding", "").lower() else None
    if whole is None and stated is not None and len(payload) != stated:
        raise BadArchive(f"HTTP length is {size}, the payload has {len(payload)}")
    if not _matches(said, payload) and (whole is None or not _matches(said, whole)):
        raise BadArchive("payload digest differs")
    payload = payload if whole is None else whole
    return *base, len(payload), digest(payload), payload


# --- frames --------------------------------------------------------------------


def dictionary_frame(dictionary: bytes) -> bytes:
    """The leading skippable frame; the dictionary in it is itself compressed."""
    body = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", DICTIONARY_FRAME, len(body)) + body


def frames(read, chunk: int = CHUNK) -> Iterator[bytes]:
    """Each frame's content, one at a time. read(n): up to n next bytes. Raises BadArchive on a cut or foreign file."""
    held = read(8)
    if not held:
        return
    magic = struct.unpack("<I", held[:4])[0] if len(held) == 8 else 0
    unpack = zstandard.ZstdDecompressor()
    if magic == DICTIONARY_FRAME:
        size = struct.unpack("<I", held[4:])[0]
        body = b"".join(_exactly(read, size))
        if body[:4] == struct.pack("<I", ZSTD_FRAME):
            one = zstandard.ZstdDecompressor().decompressobj()
            try:
                body = one.decompress(body)
            except zstandard.ZstdError as error:
                raise BadArchive(f"no dictionary: {error}") from None
            if not one.eof:
                raise BadArchive("the dictionary ends within its frame")
        unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
        held = read(chunk)
    while held:
        while len(held) < 8 and (more := read(chunk)):
            held += more
        if len(held) >= 8 and struct.unpack("<I", held[:4])[0] in SKIPPABLE_FRAMES:
            skip = 8 + struct.unpack("<I", held[4:8])[0]
            while len(held) < skip and (more := read(chunk)):
                held += more
            held = held[skip:] or read(chunk)
            continue
        one, parts = unpack.decompressobj(), []
        try:
            while True:
                parts.append(one.decompress(held))
                if one.eof:
                    break
                if not (held := read(chunk)):
                    raise BadArchive("the file ends within a frame")
        except zstandard.ZstdError as error:
            raise BadArchive(f"not a frame: {error}") from None
        held = one.unused_data or read(chunk)
        yield b"".join(parts)


def _exactly(read, size: int) -> Iterator[bytes]:
    while size:
        if not (part := read(min(size, CHUNK))):
            raise BadArchive("the file ends within its dictionary")
        size -= len(part)
        yield part


# --- Spark ---------------------------------------------------------------------


def train_dictionary(rows: DataFrame, payload: str, id_col: str, samples: int = 256, sample_bytes: int = 16384, size: int = 65536) -> bytes:
    """A dictionary from a bounded sample: `samples` rows, the first by a hash of their id, `sample_bytes` of each.

    Only the size of the archives depends on it. Empty where there is too little to learn from.
    """
    sized = rows.select(F.col(id_col).alias("i"), F.octet_length(payload).alias("size"), F.substring(payload, 1, sample_bytes).alias("part"))
    sample = sampled(sized, samples, "i", "size").select("part")
    parts = [bytes(r.part) for r in sample.collect() if r.part]
    try:
        return zstandard.train_dictionary(size, parts).as_bytes() if len(parts) >= 16 else b""
    except zstandard.ZstdError:
        return b""


def with_roles(pages: DataFrame, id_col: str, uri_col: str, payload_col: str) -> DataFrame:
    """Rows as records: rec_id, uri, n_bytes, sha1 (hex), payload (null for revisits), refers_to (null for responses), is_first.

    Payloads travel once, by (payload hash, id), a key that no group of copies
    makes hot. What refers where is found on rows without payloads, whose hot
    hashes are salted.
    """
    body = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("rec_id"), F.col(uri_col).alias("uri"), body.alias("payload")).withColumn(
        "sha", F.unhex(F.sha2("payload", 256))
    )
    firsts = written(rows.groupBy("sha").agg(F.min("rec_id").alias("first_id"), F.count(F.lit(1)).alias("copies")), "warc-firsts")
    light = rows.select("rec_id", "uri", "sha", F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("n_bytes"))
    f = firsts.select(F.col("sha").alias("f_sha"), "first_id", "copies")
    responses = (
        rows.join(f, (F.col("sha") == F.col("f_sha")) & F.col("rec_id").eqNullSafe(F.col("first_id")))
        .select("rec_id", "uri", F.octet_length("payload").cast("long").alias("n_bytes"), F.sha1("payload").alias("sha1"), "payload")
        .withColumns({"refers_to": F.lit(None).cast("long"), "is_first": F.lit(True)})
    )
    spread = f.where("copies > 1").withColumn("f_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    revisits = (
        light.withColumn("salt", F.pmod(F.xxhash64("rec_id", "uri"), F.lit(SALTS)).cast("int"))
        .join(spread, (F.col("sha") == F.col("f_sha")) & (F.col("salt") == F.col("f_salt")))
        .where(~F.col("rec_id").eqNullSafe(F.col("first_id")))
        .select("rec_id", "uri", "n_bytes", "sha1", F.lit(None).cast("binary").alias("payload"), F.col("first_id").alias("refers_to"), F.lit(False).alias("is_first"))
    )
    return responses.unionByName(revisits)


def write_archives(
    pages: DataFrame, out: str, *, id_col: str, uri_col: str, payload_col: str, date: str = "2000-01-01T00:00:00Z", level: int = 3, file_bytes: int = 64 << 20
) -> DataFrame:
    """Writes every row as a record under `out`; the manifest: path, n_records, n_bytes. A file closes once it holds `file_bytes`."""
    rows = with_roles(pages, id_col, uri_col, payload_col)
    body = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    dictionary = train_dictionary(pages.select(F.col(id_col).alias("i"), body.alias("p")), "p", "i")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, folder = fs.FileSystem.from_uri(out)
        where.create_dir(folder, recursive=True)
        learned = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if learned:
            learned.precompute_compress(level=level)
        packer = zstandard.ZstdCompressor(dict_data=learned) if learned else zstandard.ZstdCompressor(level=level)
        records = (row for batch in batches for row in _rows(batch))
        while (first := next(records, None)) is not None:
            name, n, size = f"{uuid.uuid4().hex}.warc.zst", 0, 0
            with where.open_output_stream(f"{folder}/{name}", compression=None) as file:
                if dictionary:
                    size += file.write(dictionary_frame(dictionary))
                for rec_id, uri, n_bytes, sha1, payload, refers_to, is_first in itertools.chain([first], records):
                    data = record_bytes(
                        "response" if is_first else "revisit", _urn(rec_id), uri, payload or b"", n_bytes, base64.b32encode(bytes.fromhex(sha1)).decode(), None if is_first else _urn(refers_to), date
                    )
                    size += file.write(packer.compress(data))
                    n += 1
                    if size >= file_bytes:
                        break
            yield pa.RecordBatch.from_pydict({"path": [f"{out}/{name}"], "n_records": [n], "n_bytes": [size]})

    return written(in_batches(rows, write, "path string, n_records long, n_bytes long"), "warc-manifest")


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    columns = [batch.column(i) for i in range(batch.num_columns)]
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in columns)


def _urn(rec_id: int | None) -> str:
    return f"{ID_PREFIX}{'null' if rec_id is None else rec_id}"


def read_archives(paths: DataFrame, path_col: str = "path", strict: bool = True, payloads: bool = True, tasks: int | None = None) -> DataFrame:
    """Every record of the named archives (RECORD_SCHEMA).

    strict: a broken record fails the job; else it is a row with ``problem``
    set, and where frames can no longer be told apart the file ends there.
    payloads: False leaves them out after their check.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split(" ")[0] for c in RECORD_SCHEMA.split(", ")]
        types = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string()]
        held, size = [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)

        for incoming in batches:
            for path in incoming.column(0).to_pylist():
                for row in _records(path, strict):
                    held.append(row if payloads else (*row[:6], None, row[7]))
                    size += len(row[6] or b"") if payloads else 200
                    if size >= 1 << 22 or len(held) >= 4096:
                        yield batch()
                        held, size = [], 0
        if held:
            yield batch()

    if tasks is None:
        tasks = max(1, paths.count())
    return in_batches(paths.select(F.col(path_col).alias("path")).repartition(tasks), read, RECORD_SCHEMA)


def _records(path: str, strict: bool) -> Iterator[tuple]:
    where, name = fs.FileSystem.from_uri(path)
    try:
        with where.open_input_stream(name, compression=None) as file:
            for data in frames(file.read):
                try:
                    yield *parse_record(data), None
                except BadArchive as error:
                    if strict:
                        raise
                    yield None, None, None, None, None, None, None, str(error)
    except BadArchive as error:
        if strict:
            raise BadArchive(f"{path}: {error}") from None
        yield None, None, None, None, None, None, None, str(error)


def page_archives(pages: DataFrame) -> DataFrame:
    """Pages written to archives and read back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    out = new_shared_path(pages.sparkSession, "warc")
    manifest = write_archives(pages, out, id_col="page_id", uri_col="url", payload_col="html")

    def number(c: str) -> F.Column:
        return F.expr(f"try_cast(substring({c}, {len(ID_PREFIX) + 1}) AS bigint)")

    return read_archives(manifest, payloads=False).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to")
    )
