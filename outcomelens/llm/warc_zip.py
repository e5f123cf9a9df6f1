"""Web archives packed in ZIP files, written by Spark tasks and read by byte ranges.

A package holds, all stored without compression so that every byte can be addressed,
    ``archive/data.warc.gz``  WARC/1.1 records, each a gzip member of its own,
    ``indexes/index.cdxj``    one line per record: URL, date, and JSON with its place,
    ``datapackage.json``      the members' sizes and digests.

Writing: of records with equal payloads of at least ``LEAST_BYTES`` bytes the one with the smallest page id
is a response, the others revisit it (they keep the HTTP header with the full length, and the digest, but no
payload). A task starts a new package after ``PACKAGE_BYTES``; only names that a finished task returned are
in the manifest.

Reading: the end of the file gives the central directory (ZIP64 records are followed where sizes or places need
them), the directory gives members, the local header gives the first byte of a stored member. Indexes are
read first (CDXJ, or CDX with or without a list of its fields; plain or in gzip); records are then fetched as ranges, neighbours
in one request of at most ``RANGE_BYTES``. Archives that no index names are walked from their first byte, record by
record, by the same ranges. Nothing is extracted. Records of several indexes come once. Index lines of files outside
the package lead nowhere. Of packages by other writers, records of kind warcinfo, request and metadata are not rows.

Defined results
    Null html: empty payload. Null url: no target URI. Null page_id: written, read back as null, and last when the
    smallest id is chosen. Repeated rows: one of them is the response. Empty table: no package, no rows. Extra
    columns are not written. Control characters in URLs are percent-encoded. ``pages`` must give the same
    rows in the same order when it is read twice (a stored table does). Reading records of other writers: ``page_id`` and
    ``refers_to`` are null where the record id is not one of ours; ``payload_digest`` is the SHA-256 of the payload, and for
    revisits the stated digest (with its algorithm, unless it is SHA-256) or null; ``payload_bytes`` of a revisit is null if
    its header does not tell. A stated digest that a payload does not have ends the read with an error; digests by
    algorithms not known here, and of bodies with a transfer encoding, are not compared. A compressed archive member is an error.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomelens.llm.common import open_store, prepare, query, table
from outcomelens.session import materialise, scratch_path

LEAST_BYTES = 100
PACKAGE_BYTES = 32 << 20
RANGE_BYTES = 4 << 20
DATE = "2024-01-01T00:00:00Z"
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"

_LOCAL, _CENTRAL, _END = 0x04034B50, 0x02014B50, 0x06054B50
_END64, _LOCATOR64 = 0x06064B50, 0x07064B50
_MOST32, _MOST16 = 0xFFFFFFFF, 0xFFFF


# ---- ZIP -------------------------------------------------------------------------------


class StoredZip:
    """Writes stored members to a stream; ZIP64 fields where needed, or always if ``wide``."""

    def __init__(self, out, wide: bool = False) -> None:
        self.out, self.wide, self.at, self.members = out, wide, 0, []

    def _write(self, raw: bytes) -> None:
        self.out.write(raw)
        self.at += len(raw)

    def add(self, name: str, data: bytes) -> None:
        place, raw_name, crc, size = self.at, name.encode(), zlib.crc32(data), len(data)
        wide = self.wide or size >= _MOST32
        extra = struct.pack("<HHQQ", 1, 16, size, size) if wide else b""
        short = _MOST32 if wide else size
        # Flag bit 11: names are UTF-8. The date is the format's first day.
        self._write(
            struct.pack("<IHHHHHIIIHH", _LOCAL, 45 if wide else 20, 0x800, 0, 0, 0x21, crc, short, short, len(raw_name), len(extra))
            + raw_name
            + extra
        )
        self._write(data)
        self.members.append((raw_name, crc, size, place))

    def close(self) -> None:
        start = self.at
        for name, crc, size, place in self.members:
            wide = self.wide or size >= _MOST32 or place >= _MOST32
            extra = struct.pack("<HHQQQ", 1, 24, size, size, place) if wide else b""
            short = [_MOST32] * 3 if wide else [size, size, place]
            self._write(
                struct.pack(
                    "<IHHHHHHIIIHHHHHII", _CENTRAL, 45, 45 if wide else 20, 0x800, 0, 0, 0x21, crc, short[0], short[1],
                    len(name), len(extra), 0, 0, 0, 0, short[2],
                )
                + name
                + extra
            )
        n, size = len(self.members), self.at - start
        if self.wide or n >= _MOST16 or start >= _MOST32 or size >= _MOST32:
            end64 = self.at
            self._write(struct.pack("<IQHHIIQQQQ", _END64, 44, 45, 45, 0, 0, n, n, size, start))
            self._write(struct.pack("<IIQI", _LOCATOR64, 0, end64, 1))
            n, size, start = _MOST16, _MOST32, _MOST32
        self._write(struct.pack("<IHHHHIIH", _END, 0, 0, n, n, size, start, 0))


class ZipReader:
    """Members of a ZIP file by range reads; ``source`` has ``seek`` and ``read``, ``size`` is its length."""

    def __init__(self, source, size: int) -> None:
        self.source, self.size = source, size
        self.members = {m["name"]: m for m in self._directory()}

    def read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        raw = self.source.read(n)
        if len(raw) != n:
            raise ValueError(f"file ends within a range: {at} + {n} of {self.size}")
        return raw

    def _directory(self) -> Iterator[dict]:
        tail_at = max(0, self.size - 22 - _MOST16)
        tail = self.read(tail_at, self.size - tail_at)
        found = tail.rfind(struct.pack("<I", _END))
        while found >= 0 and found + 22 + int.from_bytes(tail[found + 20 : found + 22], "little") != len(tail):
            found = tail.rfind(struct.pack("<I", _END), 0, found)
        if found < 0:
            raise ValueError("no end of central directory")
        n, size, start = struct.unpack("<HII", tail[found + 10 : found + 20])
        if n == _MOST16 or size == _MOST32 or start == _MOST32:
            at = tail_at + found - 20
            sign, _, end64, _ = struct.unpack("<IIQI", self.read(at, 20)) if at >= 0 else (0, 0, 0, 0)
            if sign == _LOCATOR64:
                end = self.read(end64, 56)
                if int.from_bytes(end[:4], "little") != _END64:
                    raise ValueError("no ZIP64 end of central directory")
                n, size, start = struct.unpack("<QQQ", end[32:56])
        raw, at = self.read(start, size), 0
        for _ in range(n):
            fields = struct.unpack("<IHHHHHHIIIHHHHHII", raw[at : at + 46])
            if fields[0] != _CENTRAL:
                raise ValueError("no central directory entry")
            method, crc, packed, full, n_name, n_extra, n_note, place = (fields[i] for i in (4, 7, 8, 9, 10, 11, 12, 16))
            name = raw[at + 46 : at + 46 + n_name].decode("utf-8", "replace")
            extra, at = raw[at + 46 + n_name :][:n_extra], at + 46 + n_name + n_extra + n_note
            while len(extra) >= 4:
                kind, length = struct.unpack("<HH", extra[:4])
                if kind == 1:
                    wide = list(struct.unpack(f"<{length // 8}Q", extra[4 : 4 + length // 8 * 8]))
                    full = wide.pop(0) if full == _MOST32 and wide else full
                    packed = wide.pop(0) if packed == _MOST32 and wide else packed
                    place = wide.pop(0) if place == _MOST32 and wide else place
                extra = extra[4 + length :]
            yield {"name": name, "method": method, "crc": crc, "size": full, "packed": packed, "header": place}

    def first_byte(self, name: str) -> int:
        """Place of a stored member's data in the file."""
        member = self.members[name]
        if member["method"] != 0:
            raise ValueError(f"{name} is compressed; only stored members can be addressed")
        return self._data(member)

    def _data(self, member: dict) -> int:
        head = self.read(member["header"], 30)
        if int.from_bytes(head[:4], "little") != _LOCAL:
            raise ValueError("no local header")
        n_name, n_extra = struct.unpack("<HH", head[26:30])
        return member["header"] + 30 + n_name + n_extra


    def content(self, name: str) -> bytes:
        """A whole member, deflated or not; for indexes."""
        member = self.members[name]
        if member["method"] == 8:
            raw = self.read(self._data(member), member["packed"])
            return zlib.decompress(raw, -15)
        return self.read(self.first_byte(name), member["size"])


# ---- WARC ------------------------------------------------------------------------------


def record(kind: str, record_id: str, url: str | None, digest: str | None, block: bytes, content: str, **more: str) -> bytes:
    """One WARC record as a gzip member."""
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", "WARC-Date": DATE}
    if url is not None:
        head["WARC-Target-URI"] = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    if digest is not None:
        head["WARC-Payload-Digest"] = f"sha256:{digest}"
    head |= {k.replace("_", "-"): v for k, v in more.items()}
    head |= {"Content-Type": content, "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def _fields(head: bytes) -> dict[str, str]:
    version, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def parse_records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of every record in a gzip member, or in plain bytes."""
    data = zlib.decompressobj(31).decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
    at = 0
    while True:
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            raise ValueError("no WARC record")
        fields = _fields(data[at:end])
        at = end + 4 + int(fields["content-length"])
        if at > len(data):
            raise ValueError("a WARC record ends too early")
        yield fields, data[end + 4 : at]
        while data[at : at + 1] in (b"\r", b"\n"):
            at += 1
        if at >= len(data):
            return


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and block of one gzip member."""
    return next(parse_records(raw))


def http_parts(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("latin-1").split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}, payload


def _name(page_id: int | None, row: int) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}:{row}"


def _page(name: str | None) -> int | None:
    """Page id in a record id of ours; null for any other."""
    ours = re.fullmatch(r"<?urn:page:(-?\d+):\d+>?", name or "")
    return int(ours[1]) if ours else None


class _Package:
    """One ZIP package in the making; its records are held until it is closed."""

    def __init__(self) -> None:
        self.parts = [record("warcinfo", f"urn:uuid:{uuid.uuid4()}", None, None, b"format: WARC File Format 1.1\r\n", "application/warc-fields")]
        self.size, self.lines = len(self.parts[0]), []

    def add(self, row: dict) -> None:
        revisit = row["refers"] is not None
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['n']}\r\n\r\n".encode()
        more = {"WARC_Refers_To": f"<{row['refers']}>", "WARC_Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
        raw = record(
            "revisit" if revisit else "response",
            row["name"],
            row["url"],
            row["digest"],
            http if revisit else http + row["payload"],
            "application/http; msgtype=response",
            **(more if revisit else {}),
        )
        place = {"offset": self.size, "length": len(raw), "filename": ARCHIVE.split("/")[1], "digest": row["digest"]}
        url = re.sub(r"\s", "%20", row["url"] or "-")
        self.lines.append(f"{url} {re.sub('[^0-9]', '', DATE)} {json.dumps(place)}")
        self.parts.append(raw)
        self.size += len(raw)

    def write(self, out) -> None:
        package = StoredZip(out)
        index = "".join(f"{line}\n" for line in sorted(self.lines)).encode()
        data = b"".join(self.parts)
        package.add(ARCHIVE, data)
        package.add(INDEX, index)
        about = [{"path": p, "bytes": len(d), "hash": f"sha256:{hashlib.sha256(d).hexdigest()}"} for p, d in ((ARCHIVE, data), (INDEX, index))]
        package.add("datapackage.json", json.dumps({"profile": "data-package", "resources": about}).encode())
        package.close()


def _write(folder: str, package_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        package = None

        def close() -> pa.RecordBatch:
            path = f"{root}/{uuid.uuid4().hex}.zip"
            with store.open_output_stream(path) as out:
                package.write(out)
            return pa.RecordBatch.from_arrays([pa.array([folder]), pa.array([path]), pa.array([len(package.lines)], pa.int64())], ["folder", "path", "records"])

        for batch in batches:
            for row in batch.to_pylist():
                first = row["first"]
                row["name"] = _name(row["page_id"], row["row"])
                row["refers"] = None if first is None or first["row"] == row["row"] else _name(first["page_id"], first["row"])
                package = package or _Package()
                package.add(row)
                if package.size >= package_bytes:
                    yield close()
                    package = None
        if package:
            yield close()

    return run


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = LEAST_BYTES,
    package_bytes: int = PACKAGE_BYTES,
) -> DataFrame:
    """Write the packages; returns the stored manifest (folder, path, records), one row per package."""
    spark = pages.sparkSession
    prepare(spark)
    folder = folder or scratch_path(spark, "warc")
    store, root = open_store(folder)
    store.create_dir(root, recursive=True)
    payload = F.coalesce(F.col(f"`{html}`").cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"),
        F.col(f"`{url}`").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("n"),
        F.sha2(payload, 256).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
    )
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row"))
    groups = (
        rows.filter(F.col("n") >= least_bytes)
        .groupBy("digest")
        .agg(first.alias("first"), F.count("*").alias("copies"))
        .filter(F.col("copies") > 1)
        .select(F.col("digest").alias("same"), "first.page_id", "first.row")
        .withColumns({"first": F.struct("page_id", "row")})
        .drop("page_id", "row")
    )
    # Short payloads have no group; a key of their own keeps equal ones from meeting in one task.
    key = F.when(F.col("n") >= least_bytes, F.col("digest")).otherwise(F.concat(F.lit("row "), F.col("row").cast("string")))
    joined = rows.withColumn("key", key).join(materialise(groups, "first_pages"), F.col("key") == F.col("same"), "left")
    written = joined.select("page_id", "url", "payload", "n", "digest", "row", "first")
    return materialise(written.mapInArrow(_write(folder, package_bytes), "folder string, path string, records long"), "packages")


#: The letters of offset, length and file name in a CDX header, and the usual orders of fields.
_OFFSET, _LENGTH, _FILE = "V", "S", "g"
_CDX_ORDERS = {11: "N b a m s k r M S V g".split(), 10: "N b a m s k r M V g".split(), 9: "N b a m s k r V g".split()}


def index_places(raw: bytes) -> Iterator[tuple[str, int, int | None]]:
    """File name, offset and length (if told) of every line of a CDXJ or CDX index, plain or in gzip."""
    order: list[str] | None = None
    for line in (gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw).decode("utf-8", "replace").splitlines():
        words = line.split()
        if not words or line.startswith("!"):
            continue
        if words[0] == "CDX":
            order = words[1:]
        elif "{" in line:
            place = json.loads(line[line.index("{") :])
            yield place["filename"], int(place["offset"]), int(place["length"]) if place.get("length") is not None else None
        else:
            place = dict(zip(order or _CDX_ORDERS.get(len(words), ()), words))
            if _FILE not in place or not place.get(_OFFSET, "").isdigit():
                raise ValueError(f"no place of a record in the index line {line[:200]!r}")
            yield place[_FILE], int(place[_OFFSET]), int(place[_LENGTH]) if place.get(_LENGTH, "").isdigit() else None


def _walk(package: ZipReader, member: str, at: int = 0) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Place, length, fields and block of the records of an archive from ``at`` on, read by ranges."""
    start, size = package.first_byte(member), package.members[member]["size"]
    held, place = b"", at  # bytes before ``place`` that are not used yet

    def more() -> bytes:
        nonlocal place
        if place >= size:
            raise ValueError(f"{member} ends within a record")
        chunk = package.read(start + place, min(RANGE_BYTES, size - place))
        place += len(chunk)
        return chunk

    while place - len(held) < size:
        first = place - len(held)
        held = held or more()
        if len(held) < 2 and place < size:
            held += more()
        if held[:2] == b"\x1f\x8b":
            unpack, parts = zlib.decompressobj(31), []
            while not unpack.eof:
                parts.append(unpack.decompress(held or more()))
                held = unpack.unused_data
            raw = b"".join(parts)
        else:
            rest = held.lstrip(b"\r\n")
            if not rest and place >= size:
                return
            first, held = place - len(rest), rest
            while (end := held.find(b"\r\n\r\n")) < 0:
                held += more()
            n = end + 4 + int(_fields(held[:end])["content-length"])
            parts, got = [held], len(held)
            while got < n:
                parts.append(more())
                got += len(parts[-1])
            whole = b"".join(parts)
            raw, held = whole[:n], whole[n:]
        for fields, block in parse_records(raw):
            yield first, place - len(held) - first, fields, block


def records_of(source, size: int) -> Iterator[tuple[str, int, int, dict[str, str], bytes]]:
    """Archive member, place in the file, length, header fields and block of every record."""
    package = ZipReader(source, size)
    places: dict[str, dict[int, int | None]] = {}
    for index in package.members:
        if re.fullmatch(r"indexes/.*\.cdxj?(\.gz)?", index):
            for name, at, n in index_places(package.content(index)):
                member = next((m for m in (f"archive/{name}", name) if m in package.members), None)
                if member:
                    own = places.setdefault(member, {})
                    own[at] = own.get(at) or n
    for member, found in places.items():
        start = package.first_byte(member)
        for at in sorted(a for a, n in found.items() if n is None):
            _, n, fields, block = next(_walk(package, member, at))
            yield member, start + at, n, fields, block
        own = sorted((a, n) for a, n in found.items() if n is not None)
        i = 0
        while i < len(own):
            j = i + 1
            while j < len(own) and own[j][0] + own[j][1] - own[i][0] <= RANGE_BYTES:
                j += 1
            low, high = own[i][0], max(a + n for a, n in own[i:j])
            chunk = package.read(start + low, high - low)
            for a, n in own[i:j]:
                fields, block = parse_record(chunk[a - low : a - low + n])
                yield member, start + a, n, fields, block
            i = j
    for member in package.members:
        if member not in places and re.search(r"\.warc(\.gz)?$", member):
            start = package.first_byte(member)
            for at, n, fields, block in _walk(package, member):
                yield member, start + at, n, fields, block


#: Algorithms of stated digests that are compared.
_ALGORITHMS = ("md5", "sha1", "sha256", "sha512")


def _stated(digest: str | None) -> tuple[str, str] | None:
    """Algorithm and lower-case hex of a stated digest (in hex or base 32); null if it is none of those known."""
    algorithm, _, value = (digest or "").partition(":")
    algorithm = algorithm.lower().replace("-", "")
    if algorithm not in _ALGORITHMS:
        return None
    width = hashlib.new(algorithm).digest_size
    if re.fullmatch(f"[0-9a-fA-F]{{{2 * width}}}", value):
        return algorithm, value.lower()
    try:
        raw = base64.b32decode(value.upper() + "=" * (-len(value) % 8))
    except ValueError:
        return None
    return (algorithm, raw.hex()) if len(raw) == width else None


def payload_of(fields: dict[str, str], block: bytes) -> tuple[int | None, str | None, bytes | None]:
    """Size, digest and bytes of a record's payload; a revisit has no bytes."""
    kind, stated = fields["warc-type"], _stated(fields.get("warc-payload-digest"))
    http, payload = http_parts(block) if "http" in fields.get("content-type", "application/http") else ({}, block)
    if kind == "revisit":
        told = http.get("content-length", "")
        digest = stated[1] if stated and stated[0] == "sha256" else fields.get("warc-payload-digest")
        return int(told) if told.isdigit() else None, digest, None
    if stated and "transfer-encoding" not in http and hashlib.new(stated[0], payload).hexdigest() != stated[1]:
        raise ValueError("a payload has another digest than its header")
    return len(payload), hashlib.sha256(payload).hexdigest(), payload


#: Kinds of records that are rows.
_KINDS = ("response", "revisit", "resource", "conversion")

_RECORD = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "package string, offset long, length long, payload binary"
)


def _read(keep_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        names = [c.strip().split(" ")[0] for c in _RECORD.split(",")]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for row in batch.to_pylist():
                store, _ = open_store(row["folder"])
                rows: list[tuple] = []
                held = 0
                with store.open_input_file(row["path"]) as source:
                    for _, at, n, fields, block in records_of(source, source.size()):
                        kind = fields.get("warc-type")
                        if kind not in _KINDS:
                            continue
                        try:
                            size, digest, payload = payload_of(fields, block)
                        except ValueError as e:
                            raise ValueError(f"{row['path']}, record at {at}: {e}") from e
                        refers = _page(fields.get("warc-refers-to")) if kind == "revisit" else None
                        page = _page(fields.get("warc-record-id"))
                        rows.append((page, fields.get("warc-target-uri"), kind, refers, size, digest, row["path"], at, n, payload if keep_payload else None))
                        held += len(payload or b"") if keep_payload else 0
                        if len(rows) >= 1_000 or held >= RANGE_BYTES:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return run


def read_archives(manifest: DataFrame, payload: bool = True) -> DataFrame:
    """One row per record of the packages, read by ranges, one task per package."""
    files = manifest.select("folder", "path")
    return files.repartition(max(1, min(files.count(), 10_000))).mapInArrow(_read(payload), _RECORD)


_SQL = """
SELECT page_id, strlen(coalesce(html, ''))::bigint AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
       CASE WHEN strlen(coalesce(html, '')) < 100 OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN strlen(coalesce(html, '')) < 100 OR page_id = first THEN NULL ELSE first END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM pages)
"""


@query("op1_warc_packages", _SQL)
def op1_warc_packages(spark, sf_dir):
    read = read_archives(write_archives(table(spark, sf_dir, "pages")), payload=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
