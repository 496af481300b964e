"""Web archives: legacy ARC files written, converted to WARC, and read back.

An ARC file opens with a version line that names the fields of its record lines; version 1 has
five, version 2 ten. The converter reads the fields by the file's own version line, takes as many
bytes as a line declares, and writes a WARC record with identifier, date, type and digests.

Of records with equal payloads one is written whole, that with the largest id, and the others as
revisits that name it and keep the payload's length in the HTTP header. Payloads meet by their
digests and never move through a shuffle; equal digests are aggregated in parts first.

Files are written by Spark's text writer in any file system Spark writes to, gzip-compressed, and read
whole, one file at a time. An ARC file is closed at ``per_file`` records or ``file_bytes`` bytes, so it
holds one record beyond that size at most, however long the payloads are; each becomes one WARC file.

Nulls: a null payload is empty; a null url is empty and stays so; null ids count as smaller than
any other, and are read back as null. A url's white space is percent-encoded, as a record line
is cut at spaces. Repeated rows are records each; of equal ids with equal payloads exactly one is
the response. An empty table gives no files and an empty result.
"""

import base64
import hashlib
import uuid
import zlib
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import functions as F

from grabqc.llm.common import keep, utf8
from grabqc.session import scratch_path

# Version lines and fields of the two versions. Fixed values.
ARC_FIELDS = {
    b"1": b"URL IP-address Archive-date Content-type Archive-length",
    b"2": b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURED = "20240101000000"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
PAGE_ID = b"page_id"


def version_block(version):
    """The first record of an ARC file: its version line and the fields of its records."""
    origin = b"grabqc"
    body = version + b" 0 " + origin + b"\n" + ARC_FIELDS[version] + b"\n"
    name = b"filedesc://pages.arc 0.0.0.0 " + CAPTURED.encode() + b" text/plain "
    return name + (b"" if version == b"1" else b"200 - - 0 pages.arc ") + b"%d\n" % len(body) + body


def quoted(url):
    """A url without white space and control characters, which would break a record line."""
    return b"".join(b"%%%02X" % b if b <= 32 or b == 127 else bytes([b]) for b in utf8(url))


def arc_record(version, page_id, url, payload):
    """One ARC record, without the line feed that follows it. The id travels in the address's fragment."""
    block = HTTP % len(payload) + payload
    digest = base64.b32encode(hashlib.sha1(payload).digest())
    line = [quoted(url) + b"#" + PAGE_ID + b"=" + (b"" if page_id is None else b"%d" % page_id), b"0.0.0.0", CAPTURED.encode(), b"text/html"]
    if version == b"2":
        line += [b"200", digest, b"-", b"0", b"pages.arc"]
    return b" ".join([*line, b"%d" % len(block)]) + b"\n" + block


def read_arc(data):
    """(fields, block) of each record of an ARC file after its version block."""
    if not data:  # the file of a task without rows
        return
    end = data.index(b"\n")
    length = int(data[:end].rsplit(b" ", 1)[1])
    body = data[end + 1:end + 1 + length].split(b"\n")
    names = body[1].split(b" ")
    if body[0].split(b" ")[0] not in ARC_FIELDS or names[-1] != b"Archive-length":
        raise ValueError("not an ARC version block")
    at = end + 1 + length
    while at < len(data):
        if data[at:at + 1] == b"\n":
            at += 1
            continue
        if data[at:at + 11] == b"filedesc://":
            yield from read_arc(data[at:])
            return
        end = data.index(b"\n", at)
        fields = dict(zip(names, data[at:end].split(b" ")))
        if len(fields) != len(names):
            raise ValueError(f"record line with {len(fields)} of {len(names)} fields")
        length = int(fields[b"Archive-length"])
        if end + 1 + length > len(data):
            raise ValueError("record shorter than its declared length")
        yield fields, data[end + 1:end + 1 + length]
        at = end + 1 + length


def payload_of(block):
    return block.split(b"\r\n\r\n", 1)[1]


def warc_record(fields, block, response=None):
    """A WARC record of an ARC record, without the two line ends that close it.

    ``response`` is the address of the record that holds an equal payload, for a revisit.
    An identifier follows from address and digest, so a revisit can name its response's.
    """
    def identifier(address):
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, address + ' ' + digest)}>"

    http, payload = block.split(b"\r\n\r\n", 1)
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    url = fields[b"URL"].decode("utf-8", "surrogateescape")
    date = datetime.strptime(fields[b"Archive-date"].decode(), "%Y%m%d%H%M%S").replace(tzinfo=timezone.utc)
    body = http + b"\r\n\r\n" + (payload if response is None else b"")
    lines = ["WARC/1.1", "WARC-Type: " + ("response" if response is None else "revisit"),
             f"WARC-Record-ID: {identifier(url)}",
             f"WARC-Date: {date.strftime('%Y-%m-%dT%H:%M:%SZ')}", f"WARC-Target-URI: {url}",
             f"WARC-IP-Address: {fields[b'IP-address'].decode()}", f"WARC-Payload-Digest: sha1:{digest}",
             "WARC-Block-Digest: sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()]
    if response is not None:
        address = response.decode("utf-8", "surrogateescape")
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {identifier(address)}", f"WARC-Refers-To-Target-URI: {address}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "surrogateescape") + body


def read_warc(data):
    """(headers, block) of each record of a WARC file."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].split(b"\r\n")
        if not first.startswith(b"WARC/1."):
            raise ValueError("not a WARC record")
        headers = dict(line.split(b": ", 1) for line in lines)
        length = int(headers[b"Content-Length"])
        yield headers, data[end + 4:end + 4 + length]
        at = end + 4 + length + 4


def unzip(data):
    out = []
    while data:
        member = zlib.decompressobj(31)
        out.append(member.decompress(data))
        data = member.unused_data
    return b"".join(out)


def _files(spark, path):
    """Path and bytes of each file. An archive without records has no files."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def _by_file(files, function, schema, columns):
    """Run a function on each row of the files; it gives the lists of one batch, so that one file is held at a time."""
    def run(batches):
        for batch in batches:
            for row in zip(*batch.columns):
                lists = function(*[v.as_py() for v in row])
                if len(lists[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(lists, schema)], schema=schema)

    return files.mapInArrow(run, columns)


def _write(volumes, path, line_end):
    """Whole files without their last line end, binary in column ``volume``, gzip-compressed, one file each."""
    (volumes.select(F.col("volume").cast("string").alias("value")).write.option("lineSep", line_end)
     .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", 1).text(path))


def write_arc(pages, path, id_col="page_id", url_col="url", payload_col="html", per_file=500, file_bytes=16 << 20):
    """Pages as ARC files; each opens with a version block, versions in turn."""
    schema = pa.schema([("volume", pa.binary())])

    def run(batches):
        version, records, size = b"1", [], 0

        def volume():
            return pa.RecordBatch.from_arrays([pa.array([b"\n".join([version_block(version)[:-1], *records])], pa.binary())], schema=schema)

        for batch in batches:
            for page_id, url, payload in zip(*batch.columns):
                records.append(arc_record(version, page_id.as_py(), url.as_py(), utf8(payload.as_py())))
                size += len(records[-1])
                if len(records) >= per_file or size >= file_bytes:
                    yield volume()
                    version, records, size = b"2" if version == b"1" else b"1", [], 0
        if records:
            yield volume()

    _write(pages.select(id_col, url_col, payload_col).mapInArrow(run, "volume binary"), path, "\n")


def _page_id(url):
    """The id that an address carries in its fragment."""
    tail = url.rsplit(b"#" + PAGE_ID + b"=", 1)[1]
    return int(tail) if tail else None


def _index(files):
    """One row for each ARC record: its place, its payload's digest and length, its address."""
    def step(path, content):
        out = []
        for i, (fields, block) in enumerate(read_arc(unzip(content))):
            payload = payload_of(block)
            out.append((path, i, hashlib.sha1(payload).digest(), len(payload), _page_id(fields[b"URL"]), fields[b"URL"]))
        return list(zip(*out)) or [()] * 6

    schema = pa.schema([("path", pa.string()), ("place", pa.int64()), ("digest", pa.binary()), ("bytes", pa.int64()), ("page_id", pa.int64()), ("url", pa.binary())])
    return _by_file(files.select("path", "content"), step, schema, "path string, place long, digest binary, bytes long, page_id long, url binary")


def convert(spark, arc_path, warc_path, min_bytes=0):
    """ARC files under ``arc_path`` as WARC files under ``warc_path``, one for one.

    Records whose payloads have at least ``min_bytes`` bytes and occur again become revisits,
    but for the one with the largest id.
    """
    files = _files(spark, arc_path)
    index = keep(_index(files).where(F.col("bytes") >= min_bytes), "arc-index")
    top = (index.groupBy("digest", "bytes").agg(F.max(F.struct("page_id", "path", "place", "url")).alias("top"), F.count("*").alias("n"))
           .where("n > 1").select("digest", "bytes", "top"))
    revisits = (index.join(top, ["digest", "bytes"]).where("NOT (path = top.path AND place = top.place)")
                .groupBy("path").agg(F.collect_list(F.struct("place", F.col("top.url").alias("url"))).alias("revisits")))

    def step(content, own):
        response = {r["place"]: r["url"] for r in own or ()}
        records = [warc_record(fields, block, response.get(i)) for i, (fields, block) in enumerate(read_arc(unzip(content)))]
        return ([b"\r\n\r\n".join(records)] if records else [],)

    # the revisits of a file are at most its records, so the files' bytes are the large side
    joined = files.join(revisits, "path", "left").select("content", "revisits")
    _write(_by_file(joined, step, pa.schema([("volume", pa.binary())]), "volume binary"), warc_path, "\r\n\r\n")


def read_back(spark, path):
    """One row for each record of WARC files, with the payload of responses."""
    def step(content):
        out = []
        for headers, block in read_warc(unzip(content)):
            kind = headers[b"WARC-Type"].decode()
            http, payload = block.split(b"\r\n\r\n", 1)
            declared = int(http.rsplit(b"Content-Length: ", 1)[1].split(b"\r\n")[0])
            digest = headers[b"WARC-Payload-Digest"].decode().removeprefix("sha1:")
            if kind == "response" and (len(payload) != declared or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                raise ValueError("payload differs from its record's header")
            refers = headers.get(b"WARC-Refers-To-Target-URI")
            url = headers[b"WARC-Target-URI"]
            out.append((_page_id(url), url.rsplit(b"#", 1)[0].decode("utf-8", "replace"), kind, declared, digest,
                        None if refers is None else _page_id(refers), payload if kind == "response" else None))
        return list(zip(*out)) or [()] * 7

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
    return _by_file(_files(spark, path).select("content"), step, schema,
                    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary")


def round_trip(pages, min_bytes=0, id_col="page_id", url_col="url", payload_col="html"):
    """Pages through ARC files and WARC files and back, under the shared scratch folder."""
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc, id_col, url_col, payload_col)
    convert(spark, arc, warc, min_bytes)
    return read_back(spark, warc)
