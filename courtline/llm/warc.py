"""WARC archives of web pages, and the normaliser of monolithic gzip files (operator 4).

1. The payload's SHA-1 and length are taken per page; groups of equal payloads of at least
   ``MIN_REVISIT`` bytes name the largest page_id as the response.
2. Each task writes its pages as records of one archive that is a single gzip stream.
3. The normaliser inflates each such file once, as a stream, rewrites every record as a gzip
   member of its own and writes a sidecar index: ``offset length record_id target_uri`` per line.
4. The archives are read back by the index, member by member, so a record can be fetched alone and a
   large archive read by many tasks.

Files are written under a name of the attempt and renamed at the end, under a name of the part, so a
task may be run again.  Any file system that ``pyarrow`` opens by URI will do.

Defined cases: null html is an empty payload and a null url an empty target; an empty table gives no
archive and an empty result; rows with a null page_id are written as responses that nothing refers to;
rows that repeat a page_id are a record each, and if their payloads are equal all of them are responses
(the response is the page, not a row); further columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm.shared import exact, opaque, saved, scratch, ship, small_enough

MIN_REVISIT = 1000
LEVEL = 3
CHUNK = 1 << 18
BROADCAST_REVISITS = 500_000  # about 30 MB of ids and digests
INDEX_ROWS = 500  # records that one row of the reading plan covers
_DATE = datetime(2024, 1, 1, tzinfo=timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")  # the pages have none


def record_id(page_id: int | None, digest: str) -> str:
    """A stable id: the same page and payload give the same record however often a task runs."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """A WARC/1.1 record.  A revisit keeps the HTTP head with the payload's length, and no payload."""
    digest = hashlib.sha1(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, digest)}",
            f"WARC-Date: {_DATE}", f"WARC-Target-URI: {' '.join(url.split())}", f"WARC-Payload-Digest: sha1:{digest}",
            f"X-Page-ID: {'' if page_id is None else page_id}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def head_of(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:60]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The records, whole and one at a time, of an inflated WARC stream that comes in pieces."""
    buffer = bytearray()
    chunks = iter(chunks)

    def grow() -> bool:
        piece = next(chunks, None)
        if piece is not None:
            buffer.extend(piece)
        return piece is not None

    while True:
        seen = 0
        while (end := buffer.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(buffer)
            if not grow():
                if bytes(buffer).strip():
                    raise ValueError("the archive ends within a record")
                return
        size = end + 4 + int(head_of(bytes(buffer[:end]))["content-length"]) + 4
        while len(buffer) < size:
            if not grow():
                raise ValueError("the archive ends within a record")
        yield bytes(buffer[:size])
        del buffer[:size]


def inflated(file) -> Iterator[bytes]:
    """The content of a gzip file of one or more members, in pieces."""
    z = zlib.decompressobj(31)
    while data := file.read(CHUNK):
        while data:
            yield z.decompress(data)
            data = z.unused_data
            if z.eof:
                z = zlib.decompressobj(31)


def _member(raw: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def _attempt(path: str) -> str:
    return f"{path}.{TaskContext.get().taskAttemptId()}.tmp"


def _write(folder: str):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = pafs.FileSystem.from_uri(folder)
        path = f"{root}/part-{TaskContext.get().partitionId():06d}.warc.gz"
        fs.create_dir(root, recursive=True)
        z, n, out = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0, None
        for b in batches:
            for page, url, html, to in zip(b["page_id"].tolist(), b["url"].tolist(), b["html"].tolist(), b["refers_to"].tolist()):
                out = out or fs.open_output_stream(_attempt(path))
                out.write(z.compress(record(page, url, html.encode("utf-8", "surrogatepass"), to)))
                n += 1
        if out:
            out.write(z.flush())
            out.close()
            fs.move(_attempt(path), path)
            yield pd.DataFrame({"file": [path.rsplit("/", 1)[1]], "records": [n]})
    return write


def _normalise(source: str, target: str):
    def normalise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = pafs.FileSystem.from_uri(source)
        out_fs, out_root = pafs.FileSystem.from_uri(target)
        out_fs.create_dir(out_root, recursive=True)
        for b in batches:
            for name in b["file"]:
                path, lines, plan, offset = f"{out_root}/{name}", [], [], 0
                with fs.open_input_stream(f"{root}/{name}", compression=None) as f, \
                        out_fs.open_output_stream(_attempt(path), compression=None) as out:
                    for raw in records(inflated(f)):
                        head, member = head_of(raw[:raw.index(b"\r\n\r\n")]), _member(raw)
                        out.write(member)
                        lines.append(f"{offset} {len(member)} {head['warc-record-id']} {head['warc-target-uri']}\n")
                        plan.append((offset, len(member)))
                        offset += len(member)
                with out_fs.open_output_stream(_attempt(f"{path}.idx"), compression=None) as out:
                    out.write("".join(lines).encode("utf-8", "surrogatepass"))
                out_fs.move(_attempt(path), path)
                out_fs.move(_attempt(f"{path}.idx"), f"{path}.idx")
                at = range(0, len(plan), INDEX_ROWS)
                yield pd.DataFrame({"file": [name] * len(at), "first": [plan[i][0] for i in at],
                                    "members": [[n for _, n in plan[i:i + INDEX_ROWS]] for i in at]})
    return normalise


READ = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"


def parsed(raw: bytes) -> tuple:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of a record, checked against its digest."""
    cut = raw.index(b"\r\n\r\n")
    head, block = head_of(raw[:cut]), raw[cut + 4:-4]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(http.lower().rpartition(b"content-length:")[2].split()[0])
    digest, kind = head["warc-payload-digest"].removeprefix("sha1:"), head["warc-type"]
    if kind == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"{head['warc-record-id']} is damaged")
    number = lambda key: int(head[key]) if head.get(key) else None
    return number("x-page-id"), head["warc-target-uri"], length, digest, kind, number("x-refers-to-page-id")


def _read(folder: str):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for b in batches:
            for name, first, members in zip(b["file"], b["first"].tolist(), b["members"]):
                rows = []
                with fs.open_input_file(f"{root}/{name}") as f:
                    f.seek(first)
                    for n in members:
                        rows.append(parsed(zlib.decompress(f.read(int(n)), 31)))
                found = pd.DataFrame(rows, columns=[c.split()[0] for c in READ.split(", ")], dtype=object)
                for c in ("page_id", "refers_to"):  # as text: see ``opaque``
                    found[c] = [None if x is None else str(x) for x in found[c]]
                yield found
    return read


def normalise(spark, names: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrite the archives ``names`` (column ``file``) of a folder; the reading plan: file, offset, member sizes."""
    ship(spark)
    files = names.select("file").repartition(max(1, min(names.count(), 100_000)), "file")
    return saved(files.mapInPandas(_normalise(source, target), "file string, first long, members array<long>"), "warc-index")


def archived(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the pages as archives, normalise these, and return what the index reads back, a row per page."""
    spark = pages.sparkSession
    ship(spark)
    folder = folder or scratch(spark, "warc")
    folder = folder if "://" in folder else f"file://{folder.removeprefix('file:')}"
    raw = F.encode("html", "UTF-8")
    source = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html")) \
        .withColumn("digest", F.sha1(raw))
    prints = saved(source.select("page_id", "digest", F.octet_length(raw).alias("n"))
                   .filter((F.col("n") >= MIN_REVISIT) & F.col("page_id").isNotNull()), "payloads")
    groups = prints.groupBy("digest", "n").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("c")) \
        .filter("c > 1").drop("c")
    groups = saved(groups, "payload-groups")  # written first, so that Spark can split the join of a large group
    # the payload is part of the key: of two payloads of one page_id, one may be a revisit and one not
    revisits = saved(prints.join(groups, ["digest", "n"]).filter("page_id <> refers_to")
                     .select("page_id", "digest", "refers_to").distinct(), "revisits")
    if small_enough(revisits, BROADCAST_REVISITS):
        revisits = F.broadcast(revisits)
    marked = source.join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "html", "refers_to")
    marked = opaque(marked, "page_id", "refers_to")
    written = saved(marked.mapInPandas(_write(f"{folder}/raw"), "file string, records long"), "warc-files")
    plan = normalise(spark, written, f"{folder}/raw", f"{folder}/normal")
    return exact(plan.mapInPandas(_read(f"{folder}/normal"), READ), "page_id", "refers_to")
