"""WARC archives with an index that is written first, and ranged reads of selected records.

``write_archives`` writes one record for each row into gzip-per-record WARC 1.1 files in a
shared folder and returns the index: file, offset, length, URL and payload digest of each
record. Payloads of at least ``MIN_REVISIT`` bytes that are equal are stored once: the row with
the smallest id is a response, the others are revisits that name it. ``read_records`` sorts the
index rows it is given by file and offset, merges neighbouring byte ranges and reads only those.

Writing. The smallest id of each payload digest comes from an aggregation with a map-side
partial step and is joined back to (id, digest) rows without payloads, so a payload that a third
of all pages share costs slim rows only; the pages themselves are dealt by id. A task writes
its archives under a new name, as a stream of at most ``ARCHIVE_BYTES`` each, and yields their
index rows; the index is stored by Spark's commit protocol, so only files of tasks that ended
well are ever named, and a lost executor's half-written files are never read.

Files are read and written through ``pyarrow.fs`` by URI (file, hdfs, s3, gs), as Spark has no
ranged binary reader.

Ids of any type that Spark casts to text and back (numbers, decimals, text, dates, times) go into the
headers as percent-encoded text. A response holds an HTTP answer with the payload; a revisit names
its response by record id, URL and date, as the standard says.

Defined results: a null payload is empty; payloads under ``MIN_REVISIT`` bytes are all
responses; rows that repeat an id and a payload are one response and revisits of it; null ids
sort last, and a group of equal payloads without any id has one response that its revisits name
by a null; an empty table gives an empty index; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import slices

MIN_REVISIT = 100
ARCHIVE_BYTES = 64 << 20
RANGE_BYTES = 4 << 20  # longest merged range, beyond one record
GAP_BYTES = 64 << 10  # ranges this near are read as one
INDEX = "page_id {id}, url string, file string, offset long, length long, payload_digest string, payload_bytes long, record_type string, refers_to {id}"
RECORDS = "page_id {id}, url string, payload binary, payload_digest string, payload_bytes long, record_type string, refers_to {id}"
_LEVEL = 1


def open_uri(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def response_id(page_id: str | None, digest: str) -> str:
    """The record id of the response that revisits of a payload refer to."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id!r}/{digest}')}>"


def _uri(url: str) -> str:
    return url.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: str | None, url: str | None, payload: bytes, digest: str, record_id: str, refers_to: tuple | None = None) -> bytes:
    """One gzip member: header and, for responses, an HTTP answer with the payload. ``refers_to`` (id and
    url of a response) makes it a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    names = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": record_id}
    names |= {"WARC-Date": "1970-01-01T00:00:00Z", "WARC-Payload-Digest": f"sha256:{digest}"}
    if url is not None:
        names["WARC-Target-URI"] = _uri(url)
    if page_id is not None:
        names["X-Page-ID"] = quote(page_id)
    names["X-Payload-Length"] = str(len(payload))
    block = http + payload
    if refers_to is not None:
        block = http
        names["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        names["WARC-Refers-To"] = response_id(refers_to[0], digest)
        if refers_to[1] is not None:
            names["WARC-Refers-To-Target-URI"] = _uri(refers_to[1])
        names["WARC-Refers-To-Date"] = names["WARC-Date"]
        if refers_to[0] is not None:
            names["X-Refers-To-Page-ID"] = quote(refers_to[0])
    names["Content-Type"], names["Content-Length"] = "application/http; msgtype=response", str(len(block))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in names.items()) + "\r\n"
    pack = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return pack.compress(head.encode("utf-8")) + pack.compress(block) + pack.compress(b"\r\n\r\n") + pack.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of one gzip member (empty for revisits); checks length and, where
    stored, digest."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *fields = head.decode("utf-8").split("\r\n")
    if not version.startswith("WARC/1."):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    names = dict(f.split(": ", 1) for f in fields)
    block = rest[: int(names["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a WARC record's length is wrong")
    payload = block.partition(b"\r\n\r\n")[2]
    if names["WARC-Type"] == "response" and names["WARC-Payload-Digest"] != "sha256:" + hashlib.sha256(payload).hexdigest():
        raise ValueError("a WARC record's digest is wrong")
    return names, payload


def _typed(rows: DataFrame, kind: str) -> DataFrame:
    """Ids that went through the archives as text, as their own type again."""
    return rows.withColumns({c: F.col(c).cast(kind) for c in ("page_id", "refers_to")})


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write archives under ``folder`` (a shared path or URI) and return the stored index."""
    spark = pages.sparkSession
    payload = F.coalesce(F.encode(F.col(payload_col).cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    kind = rows.schema["page_id"].dataType.simpleString()
    # slim rows: which page each payload's response is, nulls last
    long_rows = rows.where(F.length("payload") >= MIN_REVISIT).select("page_id", "url", "digest")
    first = long_rows.groupBy("digest").agg(
        F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url")).alias("first"), F.count("*").alias("copies")
    )
    first = first.where("copies > 1").select("digest", F.col("first.page_id").cast("string").alias("refers_to"), F.col("first.url").alias("first_url"))
    revisits = long_rows.select("page_id", "digest").distinct().join(first, "digest").withColumn("shared", F.lit(True))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # one key for null and other ids, so that the deal below also serves the join
    key = F.coalesce(F.concat(F.lit("v"), F.col("page_id").cast("string")), F.lit("n"))
    revisits = revisits.select(key.alias("k"), "digest", "shared", "refers_to", "first_url")
    keyed = rows.withColumn("k", key).repartition(n, "k", "digest").join(revisits, ["k", "digest"], "left")
    shared = F.col("shared").isNotNull().alias("shared")
    dealt = keyed.select(F.col("page_id").cast("string").alias("page_id"), "url", "payload", "digest", shared, "refers_to", "first_url")
    dealt = dealt.sortWithinPartitions("page_id", "digest", "url")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_uri(folder)
        sink, name, offset, last = None, "", 0, None
        try:
            for part in slices(batches, 2):
                out: list[tuple] = []
                for page_id, url, data, digest, shared, to, to_url in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if sink is None or offset >= ARCHIVE_BYTES:
                        if sink is not None:
                            sink.close()
                        name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                        sink = system.open_output_stream(f"{root}/{name}", compression=None)
                    # among rows that repeat the first id and its payload the first is the response
                    revisit = bool(shared) and (page_id != to or (page_id, digest) == last)
                    last = (page_id, digest)
                    own = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}/{offset}')}>"
                    named = response_id(page_id, digest) if shared and not revisit else own
                    member = record(page_id, url, data, digest, named, (to, to_url) if revisit else None)
                    sink.write(member)
                    out.append((page_id, url, name, offset, len(member), digest, len(data), "revisit" if revisit else "response", to if revisit else None))
                    offset += len(member)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=columns
                )
        finally:
            if sink is not None:
                sink.close()

    columns = [f.split()[0] for f in INDEX.split(", ")]
    types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
    system, root = open_uri(folder)
    system.create_dir(root, recursive=True)
    index = _typed(dealt.mapInArrow(run, INDEX.format(id="string")), kind)
    index.write.mode("overwrite").parquet(f"{folder}/index.parquet")
    return spark.read.parquet(f"{folder}/index.parquet")


def ranges(spans: list[tuple[int, int]]) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Merge (offset, length) spans, sorted by offset, to (start, stop, spans) ranges to read."""
    out: list[tuple[int, int, list[tuple[int, int]]]] = []
    for offset, length in spans:
        if out and offset - out[-1][1] <= GAP_BYTES and offset + length - out[-1][0] <= RANGE_BYTES:
            start, stop, members = out[-1]
            members.append((offset, length))
            out[-1] = (start, max(stop, offset + length), members)
        else:
            out.append((offset, offset + length, [(offset, length)]))
    return out


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records of the given index rows, read by sorted, merged byte ranges."""
    spark = index.sparkSession
    kind = index.schema["page_id"].dataType.simpleString()
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # a range of an archive goes to one task; a long archive is shared by several
    dealt = index.select("file", "offset", "length").repartitionByRange(n, "file", "offset").sortWithinPartitions("file", "offset")
    columns = [f.split()[0] for f in RECORDS.split(", ")]
    types = [pa.string(), pa.string(), pa.binary(), pa.string(), pa.int64(), pa.string(), pa.string()]
    as_id = lambda x: None if x is None else unquote(x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_uri(folder)
        for batch in batches:
            names, offsets, lengths = (c.to_pylist() for c in batch.columns)
            start = 0
            while start < len(names):
                stop = start
                while stop < len(names) and names[stop] == names[start]:
                    stop += 1
                with system.open_input_file(f"{root}/{names[start]}") as f:
                    for low, high, members in ranges(list(zip(offsets[start:stop], lengths[start:stop], strict=True))):
                        data = f.read_at(high - low, low)
                        out = []
                        for offset, length in members:
                            head, block = parse(data[offset - low : offset - low + length])
                            revisit = head["WARC-Type"] == "revisit"
                            digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                            size = int(head["X-Payload-Length"]) if revisit else len(block)
                            out.append((as_id(head.get("X-Page-ID")), head.get("WARC-Target-URI"), None if revisit else block, digest, size, head["WARC-Type"], as_id(head.get("X-Refers-To-Page-ID"))))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=columns
                        )
                start = stop

    return _typed(dealt.mapInArrow(run, RECORDS.format(id="string")), kind)
