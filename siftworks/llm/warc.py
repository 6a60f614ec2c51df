"""WARC archives that are read through an index.

Archives are gzipped, one member a record.  The index is written first: file,
offset, length, URL and digest of every record.  Selected records are then
read by byte ranges, sorted by offset, near ranges coalesced into one read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftworks.llm.common import ship_package, slices, text_of, work_dir

#: Schemes that Hadoop and Arrow name differently.
SCHEMES = {"s3a": "s3", "s3n": "s3"}
END = b"\r\n\r\n"
#: WARC fields want a date; archives of a table have no capture time.
EPOCH = "1970-01-01T00:00:00Z"
FIXED_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
#: Fixed value: a gzip member of no bytes.
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000002ff03000000000000000000")
INDEX = "page_id long, url string, file string, offset long, length long, digest string, record_type string"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def base32_of_hex(hex_digest: Column) -> Column:
    """Base32 of a 160-bit hex string: 15 + 15 + 10 hex digits are 12 + 12 + 8
    base-32 digits, which fit in 64 bits each."""
    parts = [(1, 15, 12), (16, 15, 12), (31, 10, 8)]
    digits = F.concat(*[F.lpad(F.conv(F.substring(hex_digest, at, n), 16, 32), to, "0") for at, n, to in parts])
    return F.translate(digits, CONV_DIGITS, FIXED_BASE32)


def clean_url(url: Column) -> Column:
    """A URL as a header value: no line ends; null reads as empty."""
    return F.regexp_replace(F.coalesce(url.cast("string"), F.lit("")), r"[\r\n]+", " ")


def plan_records(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Pages with payload, digest, record_type and refers_to.

    Of the records with equal payloads of at least ``least_bytes`` bytes the
    one with the largest page_id is the response, the others are revisits of
    it.  Rows that repeat that page_id are all responses.  Null payloads are
    empty ones.  Rows with a null id are responses unless the payload has an id.
    The winner of a payload is found on (digest, id) rows that are combined
    before the shuffle; a payload that many pages share is split by AQE.
    """
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        clean_url(F.col(f"`{url_col}`")).alias("url"),
        text_of(payload_col).alias("payload"),
    ).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    rows = rows.withColumn("sha", F.sha1(F.col("payload").cast("binary")))
    best = rows.where(F.col("payload_bytes") >= least_bytes).groupBy("sha").agg(F.max("page_id").alias("first_id"), F.count("*").alias("n"))
    best = best.where("n > 1 and first_id is not null").drop("n")
    rows = rows.join(best, "sha", "left")
    revisit = F.coalesce(F.col("first_id") != F.col("page_id"), F.col("first_id").isNotNull()) & (F.col("payload_bytes") >= least_bytes)
    return rows.select(
        "page_id",
        "url",
        "payload",
        "payload_bytes",
        base32_of_hex(F.col("sha")).alias("digest"),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def write_archive(planned: DataFrame, path: str | None = None, *, level: int = 6) -> str:
    """Write gzipped WARC files, one member a record; returns their folder.

    The files come from Spark's text writer: a record's bytes are one value and
    the line separator is an empty gzip member, which any reader of
    concatenated members skips.  Spark's commit makes each file whole or
    absent, so lost tasks and second attempts leave nothing behind.
    """
    ship_package(planned.sparkSession)
    path = path or work_dir(planned.sparkSession, "warc")
    columns = ["page_id", "url", "payload", "payload_bytes", "digest", "record_type", "refers_to"]

    def build(batches):
        import zlib

        import pyarrow as pa

        for whole in batches:
            for batch in slices(whole, 8 << 20, "payload"):
                out = []
                for page, url, payload, size, digest, kind, refers in zip(*(batch.column(c).to_pylist() for c in columns)):
                    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                    record = record_bytes(page, url, payload, size, digest, kind, refers)
                    out.append(packer.compress(record) + packer.flush())
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    (
        planned.select("page_id", "url", F.when(F.col("record_type") == "revisit", F.lit("")).otherwise(F.col("payload")).alias("payload"), *columns[3:])
        .mapInArrow(build, "record binary")
        .select(F.col("record").cast("string").alias("value"))
        .write.options(compression="none", encoding="ISO-8859-1", lineSep=EMPTY_MEMBER.decode("latin-1"))
        .text(path)
    )
    return path


def record_bytes(page: int | None, url: str, payload: str, size: int, digest: str, kind: str, refers: int | None) -> bytes:
    """One WARC/1.1 record.  Every header states the size and the digest of the
    full payload, so a revisit, which has no body, still tells them.  The digest
    is part of the record's id, as unlike pages may share their own."""
    body = payload.encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'none' if page is None else page}:{digest}>",
        f"WARC-Target-URI: {url}",
        f"WARC-Date: {EPOCH}",
        "Content-Type: text/html; charset=utf-8",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {size}",
    ]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers}:{digest}>"]
    lines.append(f"Content-Length: {len(body)}")
    return "\r\n".join(lines).encode() + END + body + END


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (first value of each name, lower-case) and body of one record."""
    head, _, rest = raw.partition(END)
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record here: {raw[:40]!r}")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        k, _, v = line.partition(": ")
        fields.setdefault(k.lower(), v)
    return fields, rest[: int(fields["content-length"])]


def members(read, chunk: int = 64 << 10):
    """(offset, length, bytes) of each gzip member of a stream that is not
    empty; ``read(n)`` gives the next bytes.  Holds one member at a time."""
    import zlib

    at, held = 0, b""
    while held or (held := read(chunk)):
        unpack, parts, used = zlib.decompressobj(31), [], 0
        while not unpack.eof:
            if not held and not (held := read(chunk)):
                raise ValueError(f"the archive ends inside the record at byte {at}")
            parts.append(unpack.decompress(held))
            used += len(held) - len(unpack.unused_data)
            held = unpack.unused_data
        if data := b"".join(parts):
            yield at, used, data
        at += used


def build_index(spark: SparkSession, path: str, to: str | None = None) -> DataFrame:
    """Scan the archives under ``path`` once and write their index: one row a
    record with file, offset, length, page_id, url, digest and record type."""
    ship_package(spark)
    to = to or work_dir(spark, "warc-index")
    listing = archive_files(spark, path)
    files = spark.createDataFrame([(f,) for f in listing], "path string")
    target = arrow_schema(INDEX)

    def scan(batches):
        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            for name in batch.column("path").to_pylist():
                system, local = fs.FileSystem.from_uri(arrow_uri(name))
                rows = []
                with system.open_input_stream(local) as f:
                    for at, size, data in members(f.read):
                        h, _ = parse_record(data)
                        rows.append((number(h["warc-record-id"]), h["warc-target-uri"], name, at, size, h["warc-payload-digest"].removeprefix("sha1:"), h["warc-type"]))
                yield pa.RecordBatch.from_pylist([dict(zip(target.names, r, strict=True)) for r in rows], schema=target)

    files.repartition(max(1, len(listing)), "path").mapInArrow(scan, INDEX).write.parquet(to)
    return spark.read.schema(INDEX).parquet(to)


def coalesced(ranges: list[tuple[int, int]], gap: int, most: int) -> list[tuple[int, int, list[int]]]:
    """Reads (offset, length, members) over sorted (offset, length) ranges: a
    range joins the read before it when at most ``gap`` bytes lie between and
    the read stays within ``most`` bytes."""
    out: list[list] = []
    for k, (at, n) in enumerate(ranges):
        if out and at - (out[-1][0] + out[-1][1]) <= gap and at + n - out[-1][0] <= most:
            out[-1][1] = max(out[-1][1], at + n - out[-1][0])
            out[-1][2].append(k)
        else:
            out.append([at, n, [k]])
    return [tuple(x) for x in out]


def read_records(index: DataFrame, *, with_payload: bool = False, gap: int = 64 << 10, most: int = 8 << 20, run_bytes: int = 64 << 20) -> DataFrame:
    """The records that the rows of ``index`` name, read by byte ranges.

    Rows are dealt by (file, run of ``run_bytes``), sorted by offset, and near
    ranges are read together.  A response's size and digest are computed from
    the body that was read, a revisit's are those that its header states.
    ``with_payload`` adds the body as binary.  The archives are opened through
    the Arrow file system of their path's scheme.
    """
    ship_package(index.sparkSession)
    schema = READ + (", payload binary" if with_payload else "")
    target = arrow_schema(schema)

    def read(batches):
        import base64
        import hashlib
        import zlib
        from itertools import groupby

        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")))
            for file, group in groupby(rows, key=lambda r: r[0]):
                here = [(at, n) for _, at, n in group]
                system, name = fs.FileSystem.from_uri(arrow_uri(file))
                with system.open_input_file(name) as f:
                    for at, size, inside in coalesced(here, gap, most):
                        block, out = f.read_at(size, at), []
                        for k in inside:
                            begin = here[k][0] - at
                            h, body = parse_record(zlib.decompress(block[begin : begin + here[k][1]], 31))
                            response = h["warc-type"] == "response"
                            digest = base64.b32encode(hashlib.sha1(body).digest()).decode() if response else h["warc-payload-digest"].removeprefix("sha1:")
                            out.append(
                                {
                                    "page_id": number(h["warc-record-id"]),
                                    "payload_bytes": len(body) if response else int(h["x-payload-length"]),
                                    "payload_digest": digest,
                                    "record_type": h["warc-type"],
                                    "refers_to": number(h["warc-refers-to"]) if "warc-refers-to" in h else None,
                                    "payload": body,
                                }
                            )
                        yield pa.RecordBatch.from_pylist(out, schema=target)

    runs = index.select("file", "offset", "length").withColumn("run", F.floor(F.col("offset") / run_bytes))
    # as many tasks as runs: index rows are small, the bytes behind them are not
    n = max(1, runs.select("file", "run").distinct().count())
    return runs.repartition(n, "file", "run").sortWithinPartitions("file", "offset").mapInArrow(read, schema)


def arrow_uri(uri: str) -> str:
    """A file's address as Arrow names its scheme: Hadoop has older and other
    names of one store."""
    scheme, found, rest = uri.partition("://")
    return f"{SCHEMES.get(scheme.lower(), scheme)}://{rest}" if found else uri


def number(urn: str) -> int | None:
    """The page's id in ``<urn:page:17:DIGEST>``."""
    name = urn.removeprefix("<urn:page:").rstrip(">").partition(":")[0]
    return None if name == "none" else int(name)


def arrow_schema(ddl: str):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def archive_files(spark: SparkSession, folder: str) -> list[str]:
    """Full names of the archives in a folder, asked from Hadoop on the driver."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at)
    names = [x.getPath().toString() for x in found if x.getPath().getName().startswith("part-")]
    return sorted(n if n.startswith("file:///") else n.replace("file:/", "file:///", 1) for n in names)
