"""WARC archives inside ZIP packages, written by tasks and read back by byte ranges.

A package is a ZIP file whose members are stored, not compressed: ``archive/data.warc.gz`` with one gzip member per
record, and ``indexes/index.cdx``, a line per record with its URL, page, digest, type, offset and length, sorted by URL. The
reader takes the end of the file, follows the directory (the ZIP64 one if there is one) to the place of every member, reads
the index and then only the bytes of records; nothing is extracted. Records of some URLs are found by the indexes alone.

Records of equal payloads are revisits of the one with the largest page id. The digest is taken where the page lies; only
the largest id of each digest is joined back.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.storage import created, new_file, range_reader
from lakeops.session import materialize, parallelism, work_dir

ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
#: Fixed values of the formats.
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
PAGE_URN = "urn:lakeops:page:"
#: Index lines that one row of work covers, and bytes of records read at a time.
RANGE_RECORDS = 512
READ_BYTES = 4 << 20


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header: int  # place of the local header


def zip_members(file) -> list[Member]:
    """The members of a ZIP file from its central directory; ``file`` has ``size()`` and ``read_at(bytes, offset)``."""
    size = file.size()
    tail_at = max(0, size - 65_557)  # the end record and the longest comment
    tail = file.read_at(size - tail_at, tail_at)
    at = tail.rfind(b"PK\x05\x06")
    while at >= 0 and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
        at = tail.rfind(b"PK\x05\x06", 0, at)  # a comment may hold the signature too
    if at < 0:
        raise ValueError("no end of a ZIP directory")
    count, length, start = struct.unpack_from("<HII", tail, at + 10)
    locator = tail_at + at - 20
    if locator >= 0 and (found := file.read_at(20, locator))[:4] == b"PK\x06\x07":
        end = file.read_at(56, struct.unpack_from("<Q", found, 8)[0])
        if end[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end record where the locator points")
        count, length, start = struct.unpack_from("<QQQ", end, 32)
    directory = file.read_at(length, start)
    members, at = [], 0
    for _ in range(count):
        if directory[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken ZIP directory")
        method, (packed, plain) = struct.unpack_from("<H", directory, at + 10)[0], struct.unpack_from("<II", directory, at + 20)
        names, extras, comments = struct.unpack_from("<HHH", directory, at + 28)
        header = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46 : at + 46 + names].decode()
        extra = directory[at + 46 + names : at + 46 + names + extras]
        place = 0
        while place + 4 <= len(extra):
            kind, room = struct.unpack_from("<HH", extra, place)
            if kind == 1:
                # Only the fields that do not fit are there, in this order.
                large = list(struct.unpack_from(f"<{room // 8}Q", extra, place + 4))
                plain = large.pop(0) if plain == 0xFFFFFFFF else plain
                packed = large.pop(0) if packed == 0xFFFFFFFF else packed
                header = large.pop(0) if header == 0xFFFFFFFF else header
            place += 4 + room
        members.append(Member(name, method, packed, header))
        at += 46 + names + extras + comments
    return members


def stored_at(file, member: Member) -> int:
    """Where the bytes of a stored member begin."""
    if member.method:
        raise ValueError(f"{member.name} is compressed")
    head = file.read_at(30, member.header)
    if head[:4] != b"PK\x03\x04":
        raise ValueError(f"no local header of {member.name}")
    return member.header + 30 + sum(struct.unpack_from("<HH", head, 26))


def payload_digest(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a binary column: four characters of each five hex digits."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    digest = F.sha1(payload)
    out = []
    for i in range(0, 40, 5):
        bits = F.conv(F.substring(digest, i + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            out.append(F.substring(F.lit(letters), F.shiftright(bits, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*out)


def roles(pages: DataFrame, min_bytes: int = 0, key: str = "page_id", payload: str = "html", url: str = "url") -> DataFrame:
    """page_id, url, payload (null for revisits), payload_bytes, payload_digest and refers_to of every page.

    Payloads of at least ``min_bytes`` that are equal refer to the page with the largest id; repeated rows of that id are
    responses each, and so are pages without an id. The largest ids are stored before the join, which leaves hot digests
    for adaptive execution to split.
    """
    bytes_of = F.encode(F.coalesce(F.col(f"`{payload}`"), F.lit("")), "utf-8")
    rows = pages.select(
        F.col(f"`{key}`").cast("long").alias("page_id"),
        F.coalesce(F.col(f"`{url}`"), F.lit("")).alias("url"),
        bytes_of.alias("payload"),
    )
    rows = rows.withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": payload_digest(F.col("payload"))}
    )
    shared = rows.filter((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull())
    largest = shared.groupBy(F.col("payload_digest").alias("digest"), F.col("payload_bytes").alias("bytes")).agg(
        F.max("page_id").alias("largest"), F.count("*").alias("n")
    )
    # Only payloads that are there more than once have anything to refer to.
    largest = materialize(largest.filter("n > 1").drop("n"), "warc-payloads")
    joined = rows.join(
        largest, (F.col("payload_digest") == F.col("digest")) & (F.col("payload_bytes") == F.col("bytes")), "left"
    )
    revisit = F.col("largest").isNotNull() & F.col("page_id").isNotNull() & (F.col("largest") != F.col("page_id"))
    return joined.select(
        "page_id",
        "url",
        F.when(~revisit, F.col("payload")).alias("payload"),
        "payload_bytes",
        "payload_digest",
        F.when(revisit, F.col("largest")).alias("refers_to"),
    )


def _uri(url: str) -> str:
    """A URL that stays on its line: blanks and control characters are encoded."""
    return "".join(c if c > " " else f"%{ord(c):02X}" for c in url)


def warc_record(page: int | None, url: str, payload: bytes | None, size: int, digest: str, refers_to: int | None) -> bytes:
    """A response record, or a revisit with the HTTP header alone, which keeps the length of the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    uri = _uri(url)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{PAGE_URN}{'' if page is None else page}>",
        f"WARC-Target-URI: {uri}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{PAGE_URN}{refers_to}>"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[int | None, int, str, str, int | None]:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of one record.

    The digest of a response is taken from its payload and must be the one it states.
    """
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]

    def page(urn: str) -> int | None:
        number = urn.strip("<>").removeprefix(PAGE_URN)
        return int(number) if number else None

    if kind == "response":
        if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError("a payload differs from its digest")
    refers = page(fields["WARC-Refers-To"]) if kind == "revisit" else None
    return page(fields["WARC-Record-ID"]), size, digest, kind, refers


class _Counted:
    """A stream that counts what it writes."""

    def __init__(self, stream):
        self.stream, self.at = stream, 0

    def write(self, data) -> int:
        self.stream.write(data)
        self.at += len(data)
        return len(data)

    def flush(self) -> None:
        pass


def write_packages(records: DataFrame, folder: str, records_per_package: int = 20_000) -> DataFrame:
    """Write the records of ``roles`` into packages and return their list, which is stored beside them.

    Packages are written where the records are, each task its own; a package that a lost task left behind is in no list.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package = None
        for batch in batches:
            for row in batch.to_pylist():
                package = package or _Package(new_file(folder, ".wacz"))
                package.add(row)
                if package.count >= records_per_package:
                    yield package.close()
                    package = None
        if package:
            yield package.close()

    written = records.mapInArrow(write, "package string, records long")
    written.write.parquet(f"{folder}/packages")
    return records.sparkSession.read.schema(written.schema).parquet(f"{folder}/packages")


class _Package:
    def __init__(self, name: str):
        self.name, self.count, self.lines = name, 0, []
        self.stream = created(name)
        self.zip = zipfile.ZipFile(_Counted(self.stream), "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)
        self.at = 0

    def add(self, row: dict) -> None:
        record = warc_record(
            row["page_id"], row["url"], row["payload"], row["payload_bytes"], row["payload_digest"], row["refers_to"]
        )
        data = gzip.compress(record, 6, mtime=0)
        self.member.write(data)
        page = "" if row["page_id"] is None else row["page_id"]
        kind = "response" if row["refers_to"] is None else "revisit"
        line = f"{page}\t{row['payload_digest']}\t{kind}\t{self.at}\t{len(data)}\n"
        self.lines.append((_uri(row["url"]), self.at, line))
        self.at += len(data)
        self.count += 1

    def close(self) -> pa.RecordBatch:
        self.member.close()
        with self.zip.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as index:
            index.write("".join(f"{uri}\t{rest}" for uri, _, rest in sorted(self.lines)).encode())
        self.zip.close()
        self.stream.close()
        return pa.RecordBatch.from_arrays(
            [pa.array([self.name]), pa.array([self.count], pa.int64())], names=["package", "records"]
        )


def _index_lines(file) -> tuple[int, list[list[str]]]:
    """Where the archive of a package begins, and its index as lists of URL, page, digest, type, offset and length."""
    members = {m.name: m for m in zip_members(file)}
    index = members[INDEX]
    lines = file.read_at(index.size, stored_at(file, index)).decode().split("\n")[:-1]
    return stored_at(file, members[ARCHIVE]), [line.split("\t") for line in lines]


def indexed(packages: DataFrame) -> DataFrame:
    """uri, page_id, payload_digest, record_type, package, offset and length of every record, by the indexes alone."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for package in batch.column(0).to_pylist():
                with range_reader(package) as file:
                    base, lines = _index_lines(file)
                uris, pages, digests, types, offsets, lengths = zip(*lines) if lines else [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(uris, pa.string()),
                        pa.array([int(page) if page else None for page in pages], pa.int64()),
                        pa.array(digests, pa.string()),
                        pa.array(types, pa.string()),
                        pa.array([package] * len(uris), pa.string()),
                        pa.array([base + int(offset) for offset in offsets], pa.int64()),
                        pa.array([int(length) for length in lengths], pa.int64()),
                    ],
                    names=["uri", "page_id", "payload_digest", "record_type", "package", "offset", "length"],
                )

    kinds = "uri string, page_id long, payload_digest string, record_type string, package string, offset long, length long"
    return packages.select("package").mapInArrow(read, kinds)


def fetch_pages(packages: DataFrame, wanted: DataFrame, key: str = "page_id") -> DataFrame:
    """page_id, uri and payload of the records whose page is among ``wanted``, read by byte ranges.

    A revisit gives the payload of the record that it refers to, found by its digest. Pages that are asked for twice count
    once; null and unknown pages have no row; repeated records have a row each.
    """
    listed = materialize(indexed(packages), "warc-index")
    asked = wanted.select(F.col(f"`{key}`").cast("long").alias("page_id")).where(F.col("page_id").isNotNull()).distinct()
    found = materialize(listed.join(asked, "page_id", "left_semi"), "warc-found")
    digests = found.select("payload_digest").distinct()
    responses = listed.where("record_type = 'response'").join(digests, "payload_digest", "left_semi")
    # Equal payloads are read once.
    one = responses.groupBy("payload_digest").agg(F.min(F.struct("package", "offset", "length")).alias("at"))
    dealt = one.select("payload_digest", "at.*").repartition(parallelism(packages.sparkSession))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = []
            for package, offset, length in zip(*[c.to_pylist() for c in batch.columns[1:]]):
                with range_reader(package) as file:
                    record = zlib.decompress(file.read_at(length, offset), 31)
                parse_record(record)  # an error if the payload differs from its digest
                payloads.append(record.split(b"\r\n\r\n", 2)[2].removesuffix(b"\r\n\r\n"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(payloads, pa.binary())], names=["payload_digest", "payload"])

    texts = dealt.mapInArrow(read, "payload_digest string, payload binary")
    return found.select("page_id", "uri", "payload_digest").join(texts, "payload_digest").select("page_id", "uri", "payload")


def located(packages: DataFrame) -> DataFrame:
    """(package, offset, lengths): runs of neighbouring records in the packages, by their directories and indexes."""

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for package in batch.column(0).to_pylist():
                with range_reader(package) as file:
                    base, lines = _index_lines(file)
                places = sorted((int(offset), int(length)) for *_, offset, length in lines)
                runs = [places[i : i + RANGE_RECORDS] for i in range(0, len(places), RANGE_RECORDS)]
                offsets = [base + run[0][0] for run in runs]
                lengths = [[length for _, length in run] for run in runs]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([package] * len(runs), pa.string()),
                        pa.array(offsets, pa.int64()),
                        pa.array(lengths, pa.list_(pa.int64())),
                    ],
                    names=["package", "offset", "lengths"],
                )

    return packages.select("package").mapInArrow(locate, "package string, offset long, lengths array<long>")


def read_packages(packages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every record, read by byte ranges.

    Large packages are dealt out run by run.
    """
    spread = parallelism(packages.sparkSession)
    runs = located(packages.repartition(spread)).repartition(spread)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for package, offset, lengths in zip(*[c.to_pylist() for c in batch.columns]):
                with range_reader(package) as file:
                    rows = [parse_record(zlib.decompress(data, 31)) for data in _ranges(file, offset, lengths)]
                columns = list(zip(*rows))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return runs.mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


def _ranges(file, offset: int, lengths: list[int]) -> Iterator[bytes]:
    """Neighbouring records, several with one read."""
    at = 0
    while at < len(lengths):
        stop, size = at + 1, lengths[at]
        while stop < len(lengths) and size + lengths[stop] <= READ_BYTES:
            size += lengths[stop]
            stop += 1
        data = file.read_at(size, offset)
        place = 0
        for length in lengths[at:stop]:
            yield data[place : place + length]
            place += length
        offset, at = offset + size, stop


def archived(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write all pages into packages in the shared folder and read the records back.

    Null payloads and URLs are empty, repeated rows have a record each, an empty table gives no rows.
    """
    folder = work_dir(pages.sparkSession, "warc")
    return read_packages(write_packages(roles(pages, min_bytes), folder))
