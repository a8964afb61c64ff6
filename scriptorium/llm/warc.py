"""Legacy web archives: ARC records of both versions become WARC records; archives are written and read by Spark."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_counted, shared_dir, small, staged

#: Bytes of records after which an archive is closed.
ARCHIVE_BYTES = 16 << 20
#: The fields of a record's header line, by ARC version.
FIELDS = {
    1: ["url", "ip", "date", "type", "length"],
    2: ["url", "ip", "date", "type", "result", "checksum", "location", "offset", "filename", "length"],
}
NAMES = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the namespace of URLs
PAGE_HEADER = "X-Page-Id"
DATE = "20240101000000"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(key: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, key)}>"


def arc_opening(version: int, name: str, date: str = DATE) -> bytes:
    """The version block with which an ARC file begins."""
    body = f"{version} 0 scriptorium\n{NAMES[version]}\n\n".encode()
    place = [f"filedesc://{name}", "0.0.0.0", date, "text/plain", "200", "-", "-", "0", name, str(len(body))]
    line = place if version == 2 else place[:4] + place[-1:]
    return " ".join(line).encode() + b"\n" + body + b"\n"


def arc_record(version: int, url: str, content: bytes, name: str, offset: int, date: str = DATE) -> bytes:
    place = [url, "0.0.0.0", date, "text/html", "200", digest32(content), "-", str(offset), name, str(len(content))]
    line = place if version == 2 else place[:4] + place[-1:]
    return " ".join(line).encode() + b"\n" + content + b"\n"


#: What a field of a header line may hold; all but the URL and the type are free of spaces.
FORMS = {"url": ".*", "type": ".*?", "date": "[0-9]{4,14}", "offset": "[0-9]+", "length": "[0-9]+"}
LINES = {version: re.compile(" ".join(f"(?P<{f}>{FORMS.get(f, '[^ ]+')})" for f in fields)) for version, fields in FIELDS.items()}


def read_arc(data: bytes, rejected: list | None = None) -> Iterator[dict]:
    """The records of an ARC file in order, the version block first; the block tells the fields of the header lines.

    Lengths are as declared, so contents may hold anything; URLs and types may hold spaces. A header that doesn't fit its version, or a
    length beyond the end, raises ValueError; with a list given as rejected, the fault is noted there instead and reading goes on behind
    the declared length, or ends where none can be made out.
    """
    at, version = 0, None
    while at < len(data):
        if data[at : at + 1] in b"\r\n":
            at += 1
            continue
        end = data.find(b"\n", at)
        line = data[at : end if end >= 0 else len(data)].rstrip(b"\r").decode("utf-8", "replace")
        if version is None:  # the version block's own line has the fields that it declares
            version = next((v for v in sorted(LINES, reverse=True) if LINES[v].fullmatch(line)), None)
        found = LINES[version].fullmatch(line) if version else None
        size = re.search(" ([0-9]+)$", line)
        fault = None if found else f"no header of its version at {at}"
        if end < 0 or (size and end + 1 + int(size[1]) > len(data)):
            fault = f"the record at {at} is cut off"
        if fault:
            if rejected is None:
                raise ValueError(fault)
            rejected.append(fault)
            if end < 0 or not size or end + 1 + int(size[1]) > len(data):
                return
        else:
            record = found.groupdict() | {"at": at, "content": data[end + 1 : end + 1 + int(size[1])]}
            if record["url"].startswith("filedesc:"):
                declared = record["content"].split(b" ", 1)[0]
                version = int(declared) if declared in (b"1", b"2") else version
            yield record
        at = end + 1 + int(size[1])


def timestamp(date: str) -> str:
    """ISO 8601 of up to 14 digits; what is missing is the earliest."""
    d = date + "00000101000000"[len(date) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(arc: dict, key: str, refers_to: str | None = None) -> bytes:
    """The WARC record of an ARC record: identifier, timestamp, type and digests are synthesised from it.

    refers_to: key of the record with the same payload; then only the HTTP header is written, as a revisit.
    """
    content = arc["content"]
    head: list[tuple[str, str]] = [("WARC-Record-ID", record_id(key)), ("WARC-Date", timestamp(arc["date"]))]
    if arc["url"].startswith("filedesc:"):
        head = [("WARC-Type", "warcinfo"), *head, ("WARC-Filename", arc["url"][11:]), ("Content-Type", "application/warc-fields")]
        content = b"format: converted from ARC\r\n"
    else:
        http = arc["url"].startswith(("http:", "https:")) and content.startswith(b"HTTP/")
        cut = content.find(b"\r\n\r\n") + 4 if http else 0
        kind = "revisit" if refers_to else "response" if http else "resource"
        head = [("WARC-Type", kind), *head, ("WARC-Target-URI", arc["url"].replace(" ", "%20")), ("WARC-Payload-Digest", "sha1:" + digest32(content[cut:]))]
        if arc["ip"] != "0.0.0.0":
            head.append(("WARC-IP-Address", arc["ip"]))
        if refers_to:
            content = content[:cut]
            head += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
        head += [("WARC-Block-Digest", "sha1:" + digest32(content)), ("Content-Type", "application/http;msgtype=response" if http else arc["type"])]
    head.append(("Content-Length", str(len(content))))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + content + b"\r\n\r\n"


def headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if k}


def read_warc(data: bytes) -> Iterator[tuple[dict, bytes]]:
    """(header fields, content block) of each record, by declared length. Cut-off records raise ValueError."""
    at = 0
    while at < len(data):
        if not data.startswith(b"WARC/", at):
            raise ValueError(f"no record at {at}")
        cut = data.find(b"\r\n\r\n", at)
        head = headers(data[at:cut])
        start, size = cut + 4, int(head["content-length"])
        if start + size > len(data):
            raise ValueError(f"the record at {at} is cut off")
        yield head, data[start : start + size]
        at = start + size
        while data[at : at + 2] == b"\r\n":
            at += 2


def unzipped(data: bytes) -> bytes:
    out = []
    while data:
        member = zlib.decompressobj(31)
        out.append(member.decompress(data))
        data = member.unused_data
    return b"".join(out)


def _clean_url(url: str | None) -> str:
    made = "".join(c if c > " " and c != "\x7f" else "%%%02X" % ord(c) for c in url or "")
    return made if made.startswith(("http:", "https:")) else "http://unknown.invalid/" + made


def page_content(page_id, html: str | None) -> bytes:
    payload = (html or "").encode("utf-8")
    name = "" if page_id is None else page_id
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{PAGE_HEADER}: {name}\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload


def convert_archives(arcs: DataFrame, name_col: str = "path", content_col: str = "content") -> DataFrame:
    """name, warc (bytes) and rejected (what couldn't be read, and where) of each ARC file (plain or gzip), for example from the binaryFile source.

    A bad record costs itself alone and is listed; one whose length can't be made out ends its file. Null contents give an empty archive.
    """
    import pyarrow as pa

    def batches(source):
        for batch in source:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data, rejected = data or b"", []
                plain = unzipped(data) if data[:2] == b"\x1f\x8b" else data
                warc = b"".join(warc_record(r, f"{name}:{r['at']}") for r in read_arc(plain, rejected))
                yield pa.RecordBatch.from_arrays([pa.array([name], pa.string()), pa.array([warc], pa.binary()), pa.array([rejected], pa.list_(pa.string()))], names=["name", "warc", "rejected"])

    return arcs.select(F.col(name_col), F.col(content_col)).mapInArrow(batches, "name string, warc binary, rejected array<string>")


def write_pages(pages: DataFrame, path: str) -> None:
    """Writes gzip WARC archives of about ARCHIVE_BYTES (before compression) with a record per page.

    Each task lays its pages out as ARC files, the versions in turn, and converts these. Of equal payloads the page
    with the largest id is the response and the others are revisits of it. Payloads aren't shuffled while
    the revisits are few enough to broadcast, which is counted; beyond that they are joined by shuffle. A payload that very
    many pages share meets them by broadcast, here and when the archives are read.
    """
    import pyarrow as pa

    payload = F.coalesce(F.col("html"), F.lit(""))
    keys = pages.select("page_id", F.sha1(payload).alias("sha1"), F.xxhash64(payload).alias("other"), F.octet_length(payload).alias("bytes"))
    keys = staged(keys, "warc-keys")
    groups = keys.groupBy("sha1", "other", "bytes").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1")
    equal = join_counted(keys, staged(groups, "warc-groups"), ["sha1", "other", "bytes"], "n")
    revisits = equal.filter("page_id != refers_to").select("page_id", "other", "refers_to").distinct()
    rows = pages.select("page_id", "url", "html", F.xxhash64(payload).alias("other")).join(small(staged(revisits, "warc-revisits")), ["page_id", "other"], "left")

    def batches(source):
        version, records, keys_of, size = 1, [], {}, 0

        def closed():
            name = f"pages-v{version}.arc"
            archive = arc_opening(version, name) + b"".join(records)
            out = []
            for i, r in enumerate(read_arc(archive)):
                if i:
                    out.append(warc_record(r, *keys_of[i]))
            # the writer puts the last record's end
            return pa.RecordBatch.from_arrays([pa.array([b"".join(out)[:-4].decode("utf-8")], pa.large_string()).cast(pa.string())], names=["value"])

        for batch in source:
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                content = page_content(page_id, html)
                records.append(arc_record(version, _clean_url(url), content, f"pages-v{version}.arc", size))
                keys_of[len(records)] = (f"page:{page_id}", None if refers_to is None else f"page:{refers_to}")
                size += len(content)
                if size >= ARCHIVE_BYTES:
                    yield closed()
                    version, records, keys_of, size = 3 - version, [], {}, 0
        if records:
            yield closed()

    archives = rows.select("page_id", "url", "html", "refers_to").mapInArrow(batches, "value string")
    options = {"compression": "gzip", "lineSep": "\r\n\r\n", "maxRecordsPerFile": 1, "zlib.compress.level": "BEST_SPEED"}
    archives.write.options(**options).text(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each record of the archives at path.

    A response's payload is measured and digested anew; a revisit has them from its headers, and refers_to is the page of the
    record whose identifier it gives.
    """
    import pyarrow as pa

    def batches(source):
        for batch in source:
            out = [[] for _ in range(6)]
            for data in batch.column(0).to_pylist():
                for head, block in read_warc(unzipped(data)):
                    cut = block.find(b"\r\n\r\n") + 4
                    http = headers(block[: cut - 4])
                    page, response = http.get(PAGE_HEADER.lower()), head["warc-type"] == "response"
                    row = (
                        int(page) if page else None,
                        len(block) - cut if response else int(http["content-length"]),
                        digest32(block[cut:]) if response else head["warc-payload-digest"].removeprefix("sha1:"),
                        head["warc-type"],
                        head["warc-record-id"],
                        head.get("warc-refers-to"),
                    )
                    for column, x in zip(out, row):
                        column.append(x)
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * 4]
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "record_id", "target_id"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, record_id string, target_id string"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    records = staged(files.mapInArrow(batches, schema), "warc-records")
    targets = records.filter("record_type = 'response'").select(F.col("record_id").alias("target_id"), F.col("page_id").alias("refers_to")).distinct()
    revisits = records.filter("record_type = 'revisit'")
    met = revisits.groupBy("target_id").agg(F.count("*").alias("met"))
    revisits = join_counted(revisits, staged(met.join(targets, "target_id", "left"), "warc-targets"), ["target_id"], "met", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    responses = records.filter("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long"))
    return responses.select(columns).unionByName(revisits.select(columns))


def archive_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Writes the pages to archives (at path, or a new place in the shared folder) and reads these back.

    Null html is an empty payload, equal to other empty ones; a null url becomes a placeholder. Rows that repeat a page id get
    a record each, with other html too; a row without an id is never the response of another. Other columns are ignored; an empty
    table gives no rows.
    """
    spark = pages.sparkSession
    path = path or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    if pages.limit(1).count() == 0:
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    write_pages(pages, path)
    return read_pages(spark, path)
