"""WARC archives with revisit records: payloads stay where they were written, only headers are shuffled."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratawork.llm.support import Scratch, if_small, open_reader, slim, write_file

#: Equal payloads from this size on are revisits; payload bytes after which an archive is closed.
MIN_REVISIT, ARCHIVE_BYTES = 100, 1 << 23
LEVEL = 3
#: Repeated digests up to which they are broadcast.
SMALL = 1 << 16
CAPTURED = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SOFTWARE = "stratawork"
_NAMESPACE = uuid.UUID("6f3f1d0e-58a1-4f0c-9a63-0c9a4d1c7b11")


def record_id(uri: str, nth: int | str) -> str:
    """The id of a record by its place, which no other record of any run has; a repeated task gives the same again."""
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{uri}#{nth}')}>"


def opening(uri: str) -> bytes:
    """The record that describes an archive, at its start."""
    fields = f"software: {SOFTWARE}\r\nformat: WARC File Format 1.1\r\n".encode()
    return member("warcinfo", [("WARC-Record-ID", record_id(uri, "info")), ("WARC-Date", CAPTURED), ("WARC-Filename", uri.rsplit("/", 1)[1]), ("Content-Type", "application/warc-fields")], fields)


def member(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own, so that any record can be read from its offset."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    c = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return c.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + c.flush()


def _clean(value: str | None) -> str:
    return "".join(ch if ch not in "\r\n" else " " for ch in value or "").strip()


def http_block(payload: bytes) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: " + str(len(payload)).encode() + b"\r\n\r\n" + payload


def records(uri: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive but those that describe it, one in memory at a time."""
    with open_reader(uri) as f:
        data = b""
        while True:
            d, parts = zlib.decompressobj(31), []
            while not d.eof:
                if not data and not (data := f.read(1 << 20)):
                    break
                parts.append(d.decompress(data))
                data = d.unused_data if d.eof else b""
            if not parts:
                return
            if not d.eof:
                raise ValueError(f"{uri} ends within a record")
            head, _, rest = b"".join(parts).partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
            if headers["WARC-Type"] != "warcinfo":
                yield headers, rest[: int(headers["Content-Length"])]


def write_archives(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One response record a row, as archives under ``root``; gives the records' headers.

    (uri, part, made, nth, page_id, payload_bytes, payload_digest, url); a null
    html is an empty payload. Archives are named by partition and number, so that a
    repeated task writes the same files.
    """

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, made, buffer, size = TaskContext.get().partitionId(), 0, [], 0
        for b in batches:
            out = []
            for page, url, html in zip(*(c.to_pylist() for c in b.columns), strict=True):
                payload = (html or "").encode()
                digest = hashlib.sha256(payload).hexdigest()
                uri, url = f"{root}/{part:07d}-{made:05d}.warc.gz", _clean(url)
                headers = [("WARC-Record-ID", record_id(uri, len(buffer))), ("WARC-Date", CAPTURED), ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Page-ID", "" if page is None else str(page)), ("Content-Type", "application/http; msgtype=response")]
                out.append((uri, part, made, len(buffer), page, len(payload), digest, url))
                buffer.append(member("response", headers, http_block(payload)))
                size += len(buffer[-1])
                if size >= ARCHIVE_BYTES:
                    write_file(uri, b"".join([opening(uri), *buffer]))
                    made, buffer, size = made + 1, [], 0
            cols = list(zip(*out, strict=True)) or [()] * 8
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["uri", "part", "made", "nth", "page_id", "payload_bytes", "payload_digest", "url"])
        if buffer:
            write_file(uri, b"".join([opening(uri), *buffer]))

    rows = slim(pages, page_id=id_col, url=url_col, html=html_col).withColumn("page_id", F.col("page_id").cast("bigint"))
    return rows.mapInArrow(run, "uri string, part int, made int, nth bigint, page_id bigint, payload_bytes bigint, payload_digest string, url string")


def counted(scratch: Scratch, headers: DataFrame) -> tuple[DataFrame, int]:
    """``headers`` with the number of their archive, from 0 without gaps, and how many archives there are.

    Archives are counted by partition; running sums are of one number each.
    """
    parts = headers.groupBy("part").agg((F.max("made") + 1).alias("k"))
    base = F.coalesce(F.sum("k").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = scratch.table("parts", parts.select("part", "k", base.alias("base")))
    total = parts.agg(F.coalesce(F.sum("k"), F.lit(0))).first()[0]
    return headers.join(if_small(parts.select("part", "base"), SMALL)[0], "part").withColumn("archive", (F.col("base") + F.col("made")).cast("int")), total


def resolve(scratch: Scratch, headers: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Of each of ``headers`` whether it revisits, and the page and place it refers to: the smallest page_id of equal payloads, where another record has it.

    Digests are counted with partial aggregates, so a digest that a third of
    all records share is summed where it lies; only digests found more than
    once come to the join, whose hot keys are split at run time. Null ids come
    last; of records with the same smallest page_id the first (by archive and place) is the
    response.
    """
    big = headers.filter(F.col("payload_bytes") >= min_bytes)
    first = big.groupBy("payload_digest").agg(F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "uri", "nth", "url")).alias("first"), F.count("*").alias("n")).filter("n > 1").select("payload_digest", "first")
    # as a table of its own, both sides of the join are plain shuffles, whose hot partitions are split
    first, _ = if_small(scratch.table("first", first), SMALL)
    joined = headers.join(first, "payload_digest", "left")
    own = (F.col("first.uri") == F.col("uri")) & (F.col("first.nth") == F.col("nth"))
    revisit = (F.col("payload_bytes") >= min_bytes) & F.col("first").isNotNull() & ~own
    return joined.select("archive", "uri", "nth", "page_id", "payload_bytes", "payload_digest", revisit.alias("revisit"), F.when(revisit, F.col("first.page_id")).alias("refers_to"), F.when(revisit, F.col("first")).alias("to"))


def rewrite_archives(resolved: DataFrame, root: str, archives: int) -> DataFrame:
    """Deduplicated archives with fresh headers: revisits lose their payload and name the record they refer to; gives (uri, records).

    Each archive is read in order beside its records' verdicts, which come to
    one task by archive: its size bounds both.
    """

    def run(key, table):
        import pyarrow as pa

        source = table.column("uri")[0].as_py()
        target = f"{root}/{source.rsplit('/', 1)[1]}"
        verdict = dict(zip(table.column("nth").to_pylist(), table.column("to").to_pylist(), strict=True))
        out = [opening(target)]
        for nth, (h, block) in enumerate(records(source)):
            to = verdict[nth]
            headers = [("WARC-Record-ID", record_id(target, nth)), *((k, h[k]) for k in ("WARC-Date", "WARC-Target-URI", "WARC-Payload-Digest", "X-Page-ID"))]
            if to:
                head, _, payload = block.partition(b"\r\n\r\n")
                block = head + b"\r\n\r\n"
                first = f"{root}/{to['uri'].rsplit('/', 1)[1]}"
                headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(first, to["nth"])), ("WARC-Refers-To-Target-URI", to["url"]), ("WARC-Refers-To-Date", CAPTURED)]
                headers += [("X-Refers-To-Page", "" if to["page_id"] is None else str(to["page_id"])), ("X-Payload-Length", str(len(payload)))]
            out.append(member("revisit" if to else "response", [*headers, ("Content-Type", "application/http; msgtype=response")], block))
        write_file(target, b"".join(out))
        return pa.table({"uri": pa.array([target], pa.string()), "records": pa.array([len(out) - 1], pa.int64())})

    # an archive a partition, by its number: its headers are few bytes, but each stands for a whole archive's work
    dealt = resolved.select("archive", "uri", "nth", "to").repartitionById(max(1, archives), F.col("archive"))
    return dealt.groupBy("archive").applyInArrow(run, "uri string, records bigint")


def read_archives(manifest: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url) of every record, from the archives alone.

    A response's digest is worked out anew from its payload and has to equal its header.
    """

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for uri in b.column(0).to_pylist():
                out = []
                for h, block in records(uri):
                    _, _, payload = block.partition(b"\r\n\r\n")
                    kind, digest = h["WARC-Type"], h["WARC-Payload-Digest"].removeprefix("sha256:")
                    n = len(payload)
                    if kind == "revisit":
                        n = int(h["X-Payload-Length"])
                    elif hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"{uri}: the payload of {h['WARC-Record-ID']} is not what its digest says")
                    page, to = h["X-Page-ID"], h.get("X-Refers-To-Page", "")
                    out.append((int(page) if page else None, n, digest, kind, int(to) if to else None, h["WARC-Target-URI"]))
                cols = list(zip(*out, strict=True)) or [()] * 6
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"])

    return manifest.select("uri").repartition(max(1, manifest.count())).mapInArrow(run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string")


def round_trip(pages: DataFrame, min_bytes: int = MIN_REVISIT, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes pages as archives, resolves revisits, writes the deduplicated archives and reads them back.

    Null html is an empty payload, null url an empty target; null ids stay
    null; of repeated ids every row is a record with an id of its own. The first archives go once
    the deduplicated ones are whole.
    """
    scratch = Scratch(pages.sparkSession, "warc")
    headers = scratch.table("headers", write_archives(pages, scratch.path("raw"), id_col, url_col, html_col))
    numbered, archives = counted(scratch, headers)
    manifest = scratch.table("manifest", rewrite_archives(resolve(scratch, numbered, min_bytes), scratch.path("final"), archives))
    scratch.drop("raw", "headers", "first", "parts")
    return read_archives(manifest).withColumnRenamed("page_id", id_col)
