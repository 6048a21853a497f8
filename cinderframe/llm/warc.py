"""Web archives: writing, normalising and reading.

write() makes one archive of each partition, a warcinfo record first, as a single gzip stream. normalise() inflates each such stream once, in
bounded pieces, rewrites every record as a gzip member of its own and writes a sidecar index (one JSON line for each
record: offset, length, id, type). read() fetches records by that index.

Archives are files in the folder that all executors share. A task writes files of fresh names and returns their paths;
only the paths that Spark commits for the task attempt that won are ever read, so a lost executor costs a rerun.

Defined results: a null payload is an empty one; a null url leaves the target header out; rows with a null id revisit
the row of the largest id with their payload, or are responses if no row has an id; rows that repeat the largest id of a
payload are all responses; an archive that ends within a record gives its whole records; an empty table makes no
archive; only the id, the url and the payload of the input are used, so other columns of any name do no harm.
"""

from __future__ import annotations

import base64
import json
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderframe.llm.common import discard, fresh_dir, opened, stash

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BLOCK = 1 << 20
#: Repeated payloads at most whose table (about 50 bytes a row) is broadcast; beyond it, pages are shuffled by digest.
BROADCAST_ROWS = 100_000
MANIFEST = "path string, records long, bytes long"


def removed(paths: list[str]) -> None:
    import os

    from pyarrow import fs

    for path in paths:
        if path.startswith("file:") or "://" not in path:
            os.unlink("/" + path.removeprefix("file:").lstrip("/"))
        else:
            system, inner = fs.FileSystem.from_uri(path)
            system.delete_file(inner)


def record(record_id: str, page_id: int | None, url: str | None, payload: bytes, sha1_hex: str, refers_to: int | None, revisit: bool) -> bytes:
    """A record of a page. The page's id, which may repeat or be missing, has a header of its own beside the record's."""
    digest = "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]"))
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Page-ID: {refers_to}"]
    head += [f"WARC-Payload-Digest: {digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def numbered(archive: str, n: int) -> str:
    """The id of an archive's n-th record: no two records share one."""
    return uuid.uuid5(uuid.NAMESPACE_URL, f"{archive}#{n}").urn


def info(archive: str) -> bytes:
    """The record that opens an archive."""
    body = b"software: cinderframe\r\nformat: WARC File Format 1.1\r\n"
    head = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: <{numbered(archive, 0)}>", f"WARC-Date: {DATE}", "Content-Type: application/warc-fields", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if k.strip()}


def inflated(file) -> Iterator[bytes]:
    """The content of a gzip file of one member or more, in pieces; stops where a cut file ends."""
    work, left = zlib.decompressobj(31), b""
    while data := left or file.read(BLOCK):
        left = b""
        piece = work.decompress(data, BLOCK)
        if piece:
            yield piece
        if work.eof:
            left, work = work.unused_data, zlib.decompressobj(31)
        else:
            left = work.unconsumed_tail


def records(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records, with the blank lines that end them."""
    held = bytearray()

    def more() -> bool:
        piece = next(pieces, None)
        held.extend(piece or b"")
        return piece is not None

    seen = 0
    while True:
        at = held.find(b"\r\n\r\n", max(0, seen - 3))
        if at < 0:
            seen = len(held)
            if not more():
                return
            continue
        end = at + 4 + int(headers(bytes(held[:at])).get("content-length", 0)) + 4
        while len(held) < end:
            if not more():
                return
        yield bytes(held[:end])
        del held[:end]
        seen = 0


def typed(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0) -> DataFrame:
    """page_id, url, payload (binary), sha1, refers_to, revisit: what each row becomes in the archive."""
    body = F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8")
    rows = pages.select(F.col(key).cast("bigint").alias("page_id"), F.col(url).alias("url"), body.alias("payload"), F.sha1(body).alias("sha1"))
    digests = pages.select(F.col(key).cast("bigint").alias("page_id"), F.sha1(body).alias("of"), F.octet_length(body).alias("n"))
    repeated = digests.where(F.col("n") >= least).groupBy("of").agg(F.max("page_id").alias("last"), F.count("*").alias("rows")).where("rows > 1").select("of", "last")
    repeated = stash(repeated, "repeated")
    joined = rows.join(F.broadcast(repeated) if repeated.count() <= BROADCAST_ROWS else repeated, F.col("sha1") == F.col("of"), "left")
    revisit = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return joined.select("page_id", "url", "payload", "sha1", F.when(revisit, F.col("last")).alias("refers_to"), revisit.alias("revisit"))


def write(rows: DataFrame, folder: str, level: int = 1) -> DataFrame:
    """Writes typed() rows, an archive for each partition that has rows; returns the manifest."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, file, work, n, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", None, zlib.compressobj(level, zlib.DEFLATED, 31), 0, 0
        for batch in batches:
            for page_id, url, payload, sha1, refers_to, revisit in zip(*(batch[c] for c in ("page_id", "url", "payload", "sha1", "refers_to", "revisit")), strict=True):
                if file is None:
                    file = opened(path, "w")
                    size += file.write(work.compress(info(path))) or 0
                data = record(numbered(path, n + 1), None if pd.isna(page_id) else int(page_id), url, payload, sha1, None if pd.isna(refers_to) else int(refers_to), revisit)
                size += file.write(work.compress(data)) or 0
                n += 1
        if file:
            size += file.write(work.flush()) or 0
            file.close()
            yield pd.DataFrame({"path": [path], "records": [n], "bytes": [size]})

    # ids as strings: pandas would turn nullable longs into floats
    return stash(rows.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")}).mapInPandas(run, MANIFEST), "archives")


def normalise(archives: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Rewrites each archive with a gzip member for each record, and writes path + '.idx'; returns the manifest."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for source in batch["path"]:
                path, at, n = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                with opened(source, "r") as old, opened(path, "w") as new, opened(path + ".idx", "w") as index:
                    for data in records(inflated(old)):
                        work = zlib.compressobj(level, zlib.DEFLATED, 31)
                        member = work.compress(data) + work.flush()
                        head = headers(data[: data.find(b"\r\n\r\n")])
                        index.write((json.dumps({"offset": at, "length": len(member), "id": head["warc-record-id"], "type": head["warc-type"]}) + "\n").encode())
                        new.write(member)
                        at, n = at + len(member), n + 1
                yield pd.DataFrame({"path": [path], "records": [n], "bytes": [at]})

    # an archive is a task's work, so each gets a task
    return stash(archives.repartition(max(1, archives.count()), "path").mapInPandas(run, MANIFEST), "normalised")


def read(archives: DataFrame) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to of each record, found by the index.

    A revisit has no payload; its size and digest are those that its headers state. A response's are recomputed.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        out, held = [], 0
        for batch in batches:
            for path in batch["path"]:
                with opened(path, "r") as file, opened(path + ".idx", "r") as index:
                    for line in index.read().splitlines():
                        entry = json.loads(line)
                        if entry["type"] == "warcinfo":
                            continue
                        file.seek(entry["offset"])
                        head, _, body = zlib.decompress(file.read(entry["length"]), 31).partition(b"\r\n\r\n")
                        named = headers(head)
                        http, _, payload = body[: int(named["content-length"])].partition(b"\r\n\r\n")
                        digest, size, revisit = named["warc-payload-digest"].removeprefix("sha1:"), int(headers(http)["content-length"]), named["warc-type"] == "revisit"
                        if not revisit and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                            raise ValueError(f"{path}: {entry} doesn't hold the payload that its headers state")
                        out.append((named.get("x-page-id"), named.get("warc-target-uri"), None if revisit else payload, size, digest, named["warc-type"], named.get("x-refers-to-page-id")))
                        held += len(payload)
                        if held > 16 * BLOCK or len(out) >= 10_000:
                            yield pd.DataFrame(out, columns=names)
                            out, held = [], 0
        if out:
            yield pd.DataFrame(out, columns=names)

    names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    found = archives.repartition(max(1, archives.count()), "path").mapInPandas(run, "page_id string, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to string")
    return found.withColumns({c: F.col(c).cast("bigint") for c in ("page_id", "refers_to")})


def roundtrip(pages: DataFrame) -> DataFrame:
    """Archives the pages, normalises the archives and reads them back."""
    folder = fresh_dir(pages.sparkSession, "warc")
    raw = write(typed(pages), folder)
    done = normalise(raw, folder)
    # a path for each archive; the raw ones are no longer needed
    raw.select("path").foreachPartition(lambda rows: removed([r["path"] for r in rows]))
    discard(raw)
    return read(done)
