"""Deterministic sharded WARC archives: written, committed by manifest, and read back.

Shards are ranges of page_id with about equal bytes.  They come from exact sums, refined where ids
are crowded, not from samples, so equal tables give equal files.  A task sorts its shard, writes one gzip member
for each record and begins a new file when the last has reached its size.  It writes under names that no
other attempt has and returns them in a manifest; what the manifest lists is then renamed, and
only what the final manifest lists is read.  Lost attempts leave nothing that a reader sees.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import partial
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm.files import located, qualified
from tillflow.sources.staging import staged

FILE_BYTES = 64 << 20  # compressed, after which a file is closed
SHARD_BYTES = 32 << 20  # payload in one task, on average
MOST_SHARDS = 16_384  # of very large tables; their shards are larger, and have several files
ROW = "row__"  # number of a scanned row
DATE = "1970-01-01T00:00:00Z"  # of records, where the pages have none
NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:tillflow:warc")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_MANIFEST = "name string, temporary string, shard int, records bigint, bytes bigint, sha1 string"
_RECORD = "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint"


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}/{digest}')}>"


def _address(url: str | None, page_id: int | None) -> str:
    """A url for a header: blanks and control characters escaped; pages without one get a name."""
    if not url:
        return f"urn:page:{page_id}"
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + packer.flush()


def _record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, refers_url: str | None, revisit: bool) -> bytes:
    digest = _digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page_id, digest if not revisit else digest + "/revisit")),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _address(url, page_id)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{_digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if url is None:
        headers.append(("X-Page-URL", "none"))
    if revisit:
        headers += [
            ("WARC-Profile", PROFILE),
            ("WARC-Refers-To", _record_id(refers_to, digest)),
            ("WARC-Refers-To-Target-URI", _address(refers_url, refers_to)),
            ("WARC-Refers-To-Date", DATE),
            ("X-Refers-To-Page-ID", str(refers_to)),
        ]
    return _member(headers, block)


def _about(name: str) -> bytes:
    fields = b"software: tillflow\r\nformat: WARC File Format 1.1\r\n"
    headers = [
        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(NAMESPACE, name)}>"),
        ("WARC-Date", DATE), ("WARC-Filename", name), ("Content-Type", "application/warc-fields"),
    ]
    return _member(headers, fields)


class _File:
    """One archive under a temporary name."""

    def __init__(self, folder: str, shard: int, number: int):
        self.system, path = located(folder)
        self.shard, self.name = shard, f"pages-{shard:06d}-{number:05d}.warc.gz"
        self.temporary = f"_temporary/{uuid.uuid4().hex}-{self.name}"
        self.system.create_dir(f"{path}/_temporary", recursive=True)
        self.out = self.system.open_output_stream(f"{path}/{self.temporary}", compression=None)
        self.sha1, self.bytes, self.records = hashlib.sha1(), 0, 0
        self.write(_about(self.name))
        self.records = 0

    def write(self, member: bytes) -> None:
        self.out.write(member)
        self.sha1.update(member)
        self.bytes += len(member)
        self.records += 1

    def close(self) -> tuple:
        self.out.close()
        return self.name, self.temporary, self.shard, self.records, self.bytes, self.sha1.hexdigest()


def _write(batches: Iterator[pa.RecordBatch], folder: str, file_bytes: int) -> Iterator[pa.RecordBatch]:
    file, number = None, 0

    def listed(row: tuple) -> pa.RecordBatch:
        types = (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string())
        names = ["name", "temporary", "shard", "records", "bytes", "sha1"]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names)

    mark = None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            shard, page_id, sha1, is_page, url, payload, refers_to, refers_url = row
            if not is_page:  # the pages that follow with this id and payload are revisits
                mark = (page_id, sha1, refers_to, refers_url)
                continue
            revisit = mark is not None and mark[:2] == (page_id, sha1)
            refers_to, refers_url = mark[2:] if revisit else (None, None)
            if file and (file.shard != shard or file.bytes >= file_bytes):
                number = number + 1 if file.shard == shard else 0
                yield listed(file.close())
                file = None
            if not file:
                file = _File(folder, shard, number)
            file.write(_record(page_id, url, payload, refers_to, refers_url, revisit))
    if file:
        yield listed(file.close())


def _publish(batch_rows: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Give the files of the manifest their names; a repeated attempt finds the work done."""
    system, path = located(folder)
    for batch in batch_rows:
        for row in batch.to_pylist():
            there = system.get_file_info(f"{path}/{row['temporary']}")
            if there.is_file:
                system.move(f"{path}/{row['temporary']}", f"{path}/{row['name']}")
            elif not system.get_file_info(f"{path}/{row['name']}").is_file:
                raise FileNotFoundError(f"{path}/{row['temporary']}")
        yield batch


class _Ranges:
    """Ranges of keys (see ``_key``) with about equal bytes, as a tree of their digits.

    A node tells its rows apart by the two digits where they first differ.  The tree grows by
    the exact sums of the rows below each node, so it is the same for equal tables.
    """

    def __init__(self) -> None:
        self.at: list[int] = []  # where each node's digits begin in the key
        self.children: list[dict[int, int]] = []  # digits to -1 - node, or to a leaf
        self.leaves: list[int] = []  # bytes of each
        self.shards: list[int] = []  # shard of each

    def node(self, low: str, high: str) -> int:
        """A new node for keys from low to high."""
        first = next(i for i in range(0, len(low), 2) if low[i : i + 2] != high[i : i + 2])
        self.at.append(first)
        self.children.append({})
        return len(self.at) - 1

    def leaf(self, size: int) -> int:
        self.leaves.append(size)
        return len(self.leaves) - 1

    def digits(self, key: Column, node: Column) -> Column:
        begin = F.get(_literal(self.at), node)
        return F.conv(F.substring(key, begin + 1, F.lit(2)), 16, 10).cast("int")

    def found(self, key: Column) -> Column:
        """The leaf of a key, or -1 - node where the tree has to grow.

        Keys that no row has are in the leaf before them, so leaves rise with keys.
        """
        flat = [n for c in self.children for n in self._filled(c)]
        table, out, seen = _literal(flat), F.lit(-1), 0
        while seen < self._height():
            node = -1 - out
            inner = (out < 0) & F.get(_literal([bool(c) for c in self.children]), node)
            out = F.when(inner, F.get(table, node * 256 + self.digits(key, node))).otherwise(out)
            seen += 1
        return out

    def _filled(self, children: dict[int, int]) -> list[int]:
        out, before = [], None
        for digits in range(256):
            if digits in children:
                before = children[digits]
                out.append(before)
            else:
                out.append(0 if not children else self._edge(min(children.items())[1], first=True) if before is None else self._edge(before))
        return out

    def _edge(self, child: int, first: bool = False) -> int:
        """The last (or first) leaf below a child."""
        while child < 0 and self.children[-1 - child]:
            below = self.children[-1 - child]
            child = below[min(below) if first else max(below)]
        return child

    def _height(self, node: int = 0) -> int:
        if not self.children[node]:
            return 0
        return 1 + max((self._height(-1 - n) for n in self.children[node].values() if n < 0), default=0)

    def deal(self, shard_bytes: int, node: int = 0, state: list[int] | None = None) -> int:
        """Give the leaves, in the order of their keys, to shards of about ``shard_bytes``; the number of shards."""
        state = [0, 0] if state is None else state
        if not node:
            self.shards = [0] * len(self.leaves)
        for digits in sorted(self.children[node]):
            child = self.children[node][digits]
            if child < 0:
                self.deal(shard_bytes, -1 - child, state)
                continue
            if state[1] >= shard_bytes:
                state[:] = [state[0] + 1, 0]
            self.shards[child] = state[0]
            state[1] += self.leaves[child]
        return state[0] + 1


def _literal(values: list) -> Column:
    """An array of numbers or truths as one literal, however long."""
    kind = "boolean" if values and isinstance(values[0], bool) else "int"
    return F.split(F.lit(",".join(str(v).lower() for v in values)), ",").cast(f"array<{kind}>")


def _key(salt: Column) -> Column:
    """Hexadecimal digits in the order of ``page_id``, rows without one last, then ``sha1``, then eight more."""
    number = F.lpad(F.hex(F.col("page_id").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    number = F.coalesce(F.concat(F.lit("00"), number), F.lit("01" + "0" * 16))
    return F.concat(number, F.upper(F.substring("sha1", 1, 16)), salt)


def _salt() -> Column:
    """By the row's number, which splits rows that are repeated as they are."""
    return F.substring(F.lpad(F.hex(F.xxhash64(ROW)), 16, "0"), 1, 8)


def _shards(narrow: DataFrame, shard_bytes: int) -> tuple[Callable[[Column], Column], int]:
    """The shard of a row by its salt, and how many there are.

    Shards are ranges of page_id (of payloads, where pages share an id) of less than twice ``shard_bytes``.
    narrow: page_id, sha1, ``ROW`` and size of all rows.  The driver gets exact sums of at most
    256 ranges below each one that is too large; there are at most ``MOST_SHARDS``.
    """
    keyed = narrow.select(_key(_salt()).alias("key"), (F.coalesce("size", F.lit(0)) + 512).alias("bytes"))
    whole = keyed.agg(F.sum("bytes").alias("bytes"), F.min("key").alias("low"), F.max("key").alias("high")).first()
    shard_bytes = max(shard_bytes, -(-(whole["bytes"] or 0) // MOST_SHARDS))
    if whole["low"] == whole["high"] or whole["bytes"] <= shard_bytes:
        return lambda salt: F.lit(0), 1
    ranges = _Ranges()
    ranges.node(whole["low"], whole["high"])
    grown = 0
    while grown < len(ranges.at):
        node = -1 - F.col("found")
        open_rows = keyed.withColumn("found", ranges.found(F.col("key"))).where("found < 0").withColumn("node", node)
        sums = open_rows.groupBy("node", ranges.digits(F.col("key"), F.col("node")).alias("digits")).agg(
            F.sum("bytes").alias("bytes"), F.min("key").alias("low"), F.max("key").alias("high")
        )
        grown = len(ranges.at)
        for r in sums.orderBy("node", "digits").collect():
            splits = r["bytes"] > shard_bytes and r["low"] != r["high"]
            child = -1 - ranges.node(r["low"], r["high"]) if splits else ranges.leaf(r["bytes"])
            ranges.children[r["node"]][r["digits"]] = child
    shards = ranges.deal(shard_bytes)
    return lambda salt: F.get(_literal(ranges.shards), ranges.found(_key(salt))), shards


def write(pages: DataFrame, folder: str, least_bytes: int = 0, file_bytes: int = FILE_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write ``page_id``, ``url``, ``html`` of every row as a record; returns the manifest.

    The payload is the html in UTF-8, null as empty.  Of rows with equal payloads of at least
    ``least_bytes``, that with the largest page_id is a response (all its repeats are), the others
    revisit it; rows without an id come after all ids.  ``folder`` must be new; its
    ``_manifest`` appears last.  No rows give no files and an empty manifest.
    """
    spark = pages.sparkSession
    folder = qualified(spark, folder)
    rows = pages.select(F.col("page_id").cast("bigint"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumns({ROW: F.monotonically_increasing_id(), "sha1": F.sha1("html")})
    narrow = staged(rows.select("page_id", "url", "sha1", ROW, F.octet_length("html").alias("size")), "pages")
    # Sums by payload are taken of narrow rows and on the map side, so a payload that
    # fills a third of the table is one row here; the join splits its side of the pages.
    same = narrow.where(F.col("size") >= least_bytes).groupBy("sha1").agg(
        F.count(F.lit(1)).alias("copies"), F.max(F.struct("page_id", "url")).alias("kept")
    )
    same = same.where("copies > 1").select("sha1", "kept")
    # Marks of revisits are found without the payloads and travel with the pages: sorted just
    # before them, so the payloads are shuffled once.
    shard_of, shards = _shards(narrow, shard_bytes)
    placed = rows.withColumn("shard", shard_of(_salt()))
    again = F.col("kept.page_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept.page_id"))
    none = F.lit(None).cast("string")
    # Repeated rows may lie in several shards, whatever their salt.
    spanned = F.sequence(shard_of(F.lit("0" * 8)), shard_of(F.lit("F" * 8)))
    marked = narrow.select("page_id", "sha1").join(same, "sha1").where(again).distinct().withColumn("shard", F.explode(spanned))
    marks = marked.select(
        "shard", "page_id", "sha1", F.lit(False).alias("is_page"), none.alias("url"), none.cast("binary").alias("payload"),
        F.col("kept.page_id").alias("refers_to"), F.col("kept.url").alias("refers_url"),
    )
    records = placed.select(
        "shard", "page_id", "sha1", F.lit(True).alias("is_page"), "url", F.col("html").cast("binary").alias("payload"),
        none.cast("bigint").alias("refers_to"), none.alias("refers_url"),
    ).unionByName(marks)
    # By the number itself: hashes of a few numbers would put many shards into one task.
    dealt = records.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "page_id", "sha1", "is_page", "url")
    manifest = staged(dealt.mapInArrow(partial(_write, folder=folder, file_bytes=file_bytes), _MANIFEST), "manifest")
    manifest.mapInArrow(partial(_publish, folder=folder), _MANIFEST).write.parquet(f"{folder}/_manifest")
    system, path = located(folder)
    if system.get_file_info(f"{path}/_temporary").type.name == "Directory":
        system.delete_dir(f"{path}/_temporary")
    return spark.read.parquet(f"{folder}/_manifest").drop("temporary")


def records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an unpacked archive."""
    while version := stream.readline():
        if not version.strip():
            continue
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {version[:40]!r}")
        headers = {}
        while line := stream.readline().strip():
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("the archive ends within a record")
        yield headers, block


def _described(headers: dict[str, str], block: bytes) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?im)^content-length:\s*(\d+)", head)[1])
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    revisit = headers["warc-type"] == "revisit"
    if headers["warc-block-digest"] != f"sha1:{_digest(block)}" or not revisit and (len(payload), _digest(payload)) != (size, digest):
        raise ValueError(f"record {headers['warc-record-id']} is damaged")
    number = headers.get("x-page-id")
    refers = headers.get("x-refers-to-page-id")
    return (
        int(number) if number else None, None if "x-page-url" in headers else headers["warc-target-uri"],
        headers["warc-type"], int(refers) if refers else None, digest, size,
    )


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    system, path = located(folder)
    types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes"]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    for listed in batches:
        for row in listed.to_pylist():
            found, count = [], 0
            with system.open_input_stream(f"{path}/{row['name']}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as stream:
                for headers, block in records(stream):
                    if headers["warc-type"] == "warcinfo":
                        continue
                    found.append(_described(headers, block))
                    count += 1
                    if len(found) == 4096:
                        yield batch(found)
                        found = []
            if count != row["records"]:
                raise ValueError(f"{row['name']} has {count} records, {row['records']} are listed")
            if found:
                yield batch(found)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each record of the committed archives; digests are checked on the way.

    A response's size and digest are those of its own payload; a revisit has them from the
    page it revisits.
    """
    folder = qualified(spark, folder)
    manifest = spark.read.parquet(f"{folder}/_manifest").select("name", "records")
    files = manifest.repartition(max(1, manifest.count()), "name")
    return files.mapInArrow(partial(_read, folder=folder), _RECORD)
