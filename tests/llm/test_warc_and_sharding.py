import base64
import hashlib
import io
import struct
import zipfile
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from lakeops.llm.sharding import lookup_table, placed, write_shards
from lakeops.llm.storage import range_reader
from lakeops.llm.warc_zip import (
    archived,
    fetch_pages,
    indexed,
    parse_record,
    read_packages,
    roles,
    stored_at,
    warc_record,
    write_packages,
    zip_members,
)
from lakeops.session import work_dir


def test_archives_equal_plain_python(spark, clashing):
    html = ["<p>é</p>", "", None, "same", "same", "x" * 2_000_000, "same", "a\r\n\r\nb"] + ["hot"] * 300
    pages = spark.createDataFrame([(i, f"http://a/{i}\r\nX: y é", h) for i, h in enumerate(html)] + [(3, None, "same"), (None, "u", "same")], "page_id long, url string, html string")
    want = []
    for i, h in [*enumerate(html), (3, "same"), (None, "same")]:
        data = (h or "").encode()
        largest = max(j for j, other in enumerate(html) if (other or "") == (h or ""))
        revisit = i is not None and i != largest
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((i, len(data), digest, "revisit" if revisit else "response", largest if revisit else None))
    got = [tuple(r) for r in archived(clashing(pages)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    # Small payloads are responses each.
    few = archived(pages, min_bytes=5).groupBy("record_type").count().collect()
    assert {r.record_type: r["count"] for r in few} == {"response": len(want)}
    assert archived(pages.limit(0)).count() == 0


def test_packages_are_readable_by_other_tools(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"page {i}") for i in range(50)], "page_id long, url string, html string")
    packages = write_packages(roles(pages).coalesce(1), work_dir(spark, "warc"), records_per_package=20)
    names = [r.package for r in packages.collect()]
    assert sorted(r.records for r in packages.collect()) == [10, 20, 20]
    with range_reader(names[0]) as file:
        data = file.read_at(file.size(), 0)
        members = {m.name: m for m in zip_members(file)}
    whole = zipfile.ZipFile(io.BytesIO(data))
    assert {i.filename: i.file_size for i in whole.infolist()} == {n: m.size for n, m in members.items()}
    assert read_packages(packages).count() == 50


def test_pages_are_found_by_the_index(spark):
    html = ["one", "two", "two", None, "é\r\n\r\n" * 3, "two"]
    rows = [(i, f"http://a/{9 - i} x", h) for i, h in enumerate(html)] + [(None, "u", "one"), (4, None, "again")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    packages = write_packages(roles(pages).repartition(3), work_dir(spark, "warc"), records_per_package=2)
    lines = indexed(packages).collect()
    assert len(lines) == len(rows)
    for package in {r.package for r in lines}:
        uris = [r.uri for r in lines if r.package == package]
        assert uris == sorted(uris) and not any(" " in uri for uri in uris)
    asked = spark.createDataFrame([(1,), (2,), (3,), (4,), (77,), (None,), (1,)], "page_id long")
    got = sorted((r.page_id, r.uri, bytes(r.payload).decode()) for r in fetch_pages(packages, asked).collect())
    assert got == [
        (1, "http://a/8%20x", "two"), (2, "http://a/7%20x", "two"), (3, "http://a/6%20x", ""),
        (4, "", "again"), (4, "http://a/5%20x", "é\r\n\r\n" * 3),
    ]
    assert fetch_pages(packages, asked.limit(0)).count() == 0


class Bytes:
    def __init__(self, data):
        self.data = data

    def size(self):
        return len(self.data)

    def read_at(self, count, offset):
        return self.data[offset : offset + count]


def test_zip64_and_comments():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package:
        package.writestr("a", b"first")
        package.writestr("b" * 300, b"second")
        package.comment = b"PK\x05\x06 in a comment" + bytes(40)
    file = Bytes(out.getvalue())
    found = zip_members(file)
    assert [file.read_at(m.size, stored_at(file, m)) for m in found] == [b"first", b"second"]
    # The same with a ZIP64 directory: all 32-bit fields say that the 64-bit ones count.
    data = b"junk"
    header = len(data)
    data += struct.pack("<IHHHHHIIIHH", 0x04034B50, 45, 0, 0, 0, 0, 0, 4, 4, 1, 0) + b"zdata"
    start = len(data)
    extra = struct.pack("<HHQQQ", 1, 24, 4, 4, header)
    data += struct.pack("<IHHHHHHIIIHHHHHII", 0x02014B50, 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 1, len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + b"z" + extra
    end = len(data)
    data += struct.pack("<IQHHIIQQQQ", 0x06064B50, 44, 45, 45, 0, 0, 1, 1, end - start, start)
    data += struct.pack("<IIQI", 0x07064B50, 0, end, 1)
    data += struct.pack("<IHHHHIIH", 0x06054B50, 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    file = Bytes(data)
    (member,) = zip_members(file)
    assert file.read_at(member.size, stored_at(file, member)) == b"data"
    with pytest.raises(ValueError, match="no end"):
        zip_members(Bytes(b"nothing"))


def test_a_payload_that_differs_from_its_digest_is_an_error():
    record = warc_record(1, "u", b"abc", 3, base64.b32encode(hashlib.sha1(b"abc").digest()).decode(), None)
    assert parse_record(record)[:2] == (1, 3)
    with pytest.raises(ValueError, match="digest"):
        parse_record(record.replace(b"abc", b"abd"))


def test_lookup_table():
    names = [f"s{i}" for i in range(10)]
    table = lookup_table(names, 1009)
    assert set(Counter(table).values()) <= {100, 101}
    fewer = lookup_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 9)
    assert moved < 0.15 * 1009
    weighted = Counter(lookup_table(names, 1009, {"s0": 0.5, "s1": 0.0}))
    assert weighted[1] == 0 and weighted[0] == pytest.approx(0.5 * weighted[2], abs=3)
    for bad in ((names, 1000), ([], 7), (["a", "a"], 7), (names, 7)):
        with pytest.raises(ValueError):
            lookup_table(*bad)


def plain_table(names, size):
    """Each name's permutation written out, and the names claiming slots in turn."""

    def number(name, salt):
        return int.from_bytes(hashlib.blake2b(f"{salt}:{name}".encode(), digest_size=8).digest(), "big")

    wishes = {
        name: iter([(number(name, "start") + i * (number(name, "step") % (size - 1) + 1)) % size for i in range(size)])
        for name in names
    }
    owner = {}
    while len(owner) < size:
        for name in sorted(names):
            if len(owner) < size:
                owner[next(slot for slot in wishes[name] if slot not in owner)] = name
    return [names.index(owner[slot]) for slot in range(size)]


@pytest.mark.parametrize("count, size", [(1, 2), (3, 101), (64, 4099), (101, 101)])
def test_table_equals_written_out_permutations(count, size):
    names = [f"shard-{i:03d}" for i in range(count)][::-1]
    assert lookup_table(names, size) == plain_table(names, size)


def test_rows_of_hot_keys_have_the_same_place_on_every_run(spark):
    rows = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    names = [f"s{i}" for i in range(6)]
    places = [
        {r.id: r.shard for r in placed(df, ["k"], names, 101).collect()}
        for df in (rows, rows.repartition(7), rows.orderBy(F.col("id").desc()))
    ]
    assert places[0] == places[1] == places[2] and len(places[0]) == 4000
    assert max(Counter(places[0].values()).values()) < 0.35 * 4000


def plain_slot(key, size):
    data = b"" if key is None else int(key).to_bytes(8, "little", signed=True)
    value = xxhash.xxh64_intdigest(data, 42) if key is not None else 42
    return (value - (1 << 64) if value >> 63 else value) % size


def test_placing(spark, hard_docs, no_docs, clashing):
    names = [f"s{i}" for i in range(5)]
    table = lookup_table(names, 101)
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("x").alias("_pieces"))
    for row in placed(docs, ["doc_id"], names, 101).collect():
        assert row.slot == plain_slot(row.doc_id, 101) and row.shard == names[table[row.slot]]
    hot = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot"))
    counts = placed(hot, ["source"], names, 101).groupBy("source", "shard").count().collect()
    # Two keys hold all rows; both are dealt over several shards, and no row is lost.
    assert sum(r["count"] for r in counts) == 3000 and len(counts) > 5
    assert placed(no_docs, ["doc_id"], names, 101).count() == 0
    out = placed(clashing(hard_docs).drop("slot"), ["doc_id", "lang"], names, 101)
    assert out.count() == hard_docs.count()
    folder = work_dir(spark, "shards")
    write_shards(out, folder)
    assert spark.read.parquet(folder).count() == hard_docs.count()
