"""WARC: pages as monolithic gzip archives, normalised to one gzip member a record with an offset index.

Writing is a text sink with gzip: each file is one gzip stream of many records. The normaliser inflates
such a file once, in pieces, and writes each record as a gzip member of its own, beside a sidecar index of
offsets. Reading back follows the index: each record is read by offset and length alone.

Each attempt of a task writes files under a name of its own, and only the rows of attempts that
succeeded reach the index table: a lost executor leaves files that nothing refers to, and nothing else.
The archives lie in the shared folder, reached through the file system that its URI names.

Defined results: a null payload is empty; equal payloads count together down to the empty one; rows with
a null ``page_id`` are revisits where another row with an id has the same payload, else responses;
repeated rows of the least id are all responses; characters that would end a header line are
percent-encoded in urls.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covisit_spark.llm.common import new_path, stage

CRLF, END = "\r\n", "\r\n\r\n"
# Fixed value: the alphabet of base32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PIECE = 1 << 20


def base32_of_hex(digest: Column) -> Column:
    """Base32 of a 40-digit hexadecimal string: five digits make four letters."""
    letters = []
    for g in range(8):
        v = F.conv(F.substring(digest, 5 * g + 1, 5), 16, 10).cast("int")
        for s in (15, 10, 5, 0):
            letters.append(F.substr(F.lit(BASE32), F.shiftright(v, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)))
    return F.concat(*letters)


def records(pages: DataFrame, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """One WARC record a page, as text (``value``): of equal payloads, all but that of the least id are revisits.

    The digests are joined first, by themselves: the payloads are shuffled only if the table of repeated
    digests is too large to broadcast.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    given = pages.select(
        "page_id",
        F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A").alias("uri"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("bytes"),
        F.sha1(payload.cast("binary")).alias("sha1"),
    )
    repeated = stage(
        given.where(F.col("bytes") >= min_bytes)
        .groupBy("sha1")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where((F.col("n") > 1) & F.col("first").isNotNull())
        .select("sha1", "first"),
        "warc-digests",
    )
    r = given.join(repeated, "sha1", "left")
    again = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), page, F.lit(">"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.col("uri")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.col("sha1")))),
        line("X-Payload-Length", F.col("bytes").cast("string")),
        F.when(
            again,
            F.concat(
                line("WARC-Profile", F.lit(PROFILE)),
                line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">"))),
            ),
        ).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(again, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
        F.lit(CRLF),
    )
    return r.select(F.when(again, head).otherwise(F.concat(head, "payload")).alias("value"))


def write_monolithic(values: DataFrame, path: str, records_per_file: int = 20_000) -> None:
    """Records as gzip files of one stream each; every record ends with two line ends."""
    values.write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).text(path, compression="gzip")


def file_system(uri: str):
    """(file system, path) of a URI; ``file:/x`` is written ``file:///x`` for Arrow."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def inflated(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """The plain bytes of a gzip stream, also if further members follow; zero bytes between and after members are padding.

    A stream that ends before its trailer, whose checksum was then never held against the bytes, raises.
    """
    d, begun = zlib.decompressobj(31), False
    for piece in pieces:
        while piece:
            if d.eof:
                piece = piece.lstrip(b"\0")
                if not piece:
                    break
                d = zlib.decompressobj(31)
            begun = True
            plain = d.decompress(piece, PIECE)
            if plain:
                yield plain
            piece = d.unused_data if d.eof else d.unconsumed_tail
    rest = d.flush()
    if rest:
        yield rest
    if begun and not d.eof:
        raise ValueError("gzip stream breaks off")


def headers(block: bytes) -> dict[str, str]:
    pairs = (x.partition(":") for x in block.decode("utf-8").split(CRLF)[1:] if x)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def split_records(plain: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, whole record) one by one; holds one record and one piece at a time."""
    held, at, need, head = bytearray(), 0, None, {}
    for piece in plain:
        held += piece
        while True:
            if need is None:
                end = held.find(END.encode(), at)
                if end < 0:
                    break
                head = headers(bytes(held[at:end]))
                need = end - at + 4 + int(head["content-length"]) + 4
            if len(held) - at < need:
                break
            yield head, bytes(held[at : at + need])
            at, need = at + need, None
        del held[:at]
        at = 0
    if held:
        raise ValueError("archive ends inside a record")


def normalise_file(uri: str, target: str) -> list[tuple]:
    """Rewrite one monolithic archive; index rows (archive, offset, length, record, type)."""
    import uuid

    source, path = file_system(uri)
    name = f"{target}/{path.rpartition('/')[2].removesuffix('.txt.gz')}-{uuid.uuid4().hex}.warc.gz"
    sink, out_path = file_system(name)
    sink.create_dir(out_path.rpartition("/")[0], recursive=True)
    rows, offset = [], 0
    with source.open_input_stream(path, compression=None) as raw, sink.open_output_stream(out_path, compression=None) as out:
        for head, record in split_records(inflated(iter(lambda: raw.read(PIECE), b""))):
            c = zlib.compressobj(6, zlib.DEFLATED, 31)
            member = c.compress(record) + c.flush()
            out.write(member)
            rows.append((name, offset, len(member), head["warc-record-id"], head["warc-type"]))
            offset += len(member)
    with sink.open_output_stream(out_path + ".index", compression=None) as out:
        out.write("".join(f"{r[1]}\t{r[2]}\t{r[3]}\t{r[4]}\n" for r in rows).encode())
    return rows


def normalise(spark, raw: str, target: str) -> DataFrame:
    """Normalise every archive under ``raw`` into ``target``; the index of all records as a stored table."""

    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        for f in frames:
            for uri in f["path"]:
                yield pd.DataFrame(normalise_file(uri, target), columns=["archive", "offset", "length", "record", "kind"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(raw).select("path")
    return stage(files.mapInPandas(run, "archive string, offset long, length long, record string, kind string"), "warc-index")


def parse(record: bytes) -> tuple:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of one record; checks payload and digest."""
    end = record.index(END.encode())
    head = headers(record[:end])
    payload = record[end + 4 : end + 4 + int(head["content-length"])]
    number = lambda urn: int(x) if (x := urn.removeprefix("<urn:page:").removesuffix(">")) else None
    digest, size = head["warc-payload-digest"].removeprefix("sha1:"), int(head["x-payload-length"])
    if head["warc-type"] == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if (found, len(payload)) != (digest, size):
            raise ValueError(f"payload of {head['warc-record-id']} does not match its digest")
    first = number(head["warc-refers-to"]) if "warc-refers-to" in head else None
    return number(head["warc-record-id"]), size, digest, head["warc-type"], first


def read_back(index: DataFrame, bytes_per_task: int = 8 << 20) -> DataFrame:
    """Each record by its offset and length, checked against its digest."""
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // bytes_per_task))
    dealt = index.select("archive", "offset", "length").repartitionByRange(tasks, "archive", "offset")

    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        for f in frames:
            rows = []
            for archive, own in f.sort_values(["archive", "offset"]).groupby("archive", sort=False):
                where, path = file_system(archive)
                with where.open_input_file(path) as src:
                    for offset, length in zip(own["offset"], own["length"], strict=True):
                        rows.append(parse(zlib.decompress(src.read_at(int(length), int(offset)), 31)))
            out = pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
            yield out.astype({"page_id": "Int64", "payload_bytes": "int64", "refers_to": "Int64"})

    return dealt.mapInPandas(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


def archive_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write, normalise and read back: one row per page."""
    spark = pages.sparkSession
    raw, target = new_path(spark, "warc-raw"), new_path(spark, "warc")
    write_monolithic(records(pages, min_bytes), raw)
    return read_back(normalise(spark, raw, target))
