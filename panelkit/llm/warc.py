"""WARC archives with revisit records.

Headers (digest, length, id) are shuffled by payload digest; the first page of a
digest is the response, the other pages become revisits that name it. Payloads
move once, and equal ones are merged before they move. Archives are written by
Spark's text sink, whose line separator is the blank pair of lines that ends a
record, so that lost tasks leave no half archives.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm.common import in_arrow, release, settled
from panelkit.runtime import scratch_dir

END = "\r\n\r\n"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records of one archive at most; with the size of a page it bounds what a reader holds.
ARCHIVE_RECORDS = 1000
#: The date of all records is a parameter, so that archives are reproducible.
DATE = "2024-01-01T00:00:00Z"


def base32(hex_digest: Column) -> Column:
    """Upper-case base32 of a 40-digit hexadecimal digest."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    letters = [
        F.substring(F.lit(alphabet), F.conv(F.substring(bits, 5 * k + 1, 5), 2, 10).cast("int") + 1, F.lit(1))
        for half in range(8)
        for bits in [F.lpad(F.conv(F.substring(hex_digest, 5 * half + 1, 5), 16, 2), 20, "0")]
        for k in range(4)
    ]
    return F.concat(*letters)


def _header(kind: str, length: Column, refers: Column | None = None) -> Column:
    def line(name: str, value: Column | str) -> Column:
        value = F.lit(value) if isinstance(value, str) else value
        return F.concat(F.lit(f"\r\n{name}: "), value)

    record = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page").cast("string"), F.lit("")), F.lit(">"))
    url = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\x00-\x20]", "")
    lines = [
        F.lit(VERSION), line("WARC-Type", kind), line("WARC-Record-ID", record), line("WARC-Date", DATE),
        line("WARC-Target-URI", url), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
    ]
    if refers is not None:
        lines += [line("WARC-Profile", PROFILE), line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), refers, F.lit(">")))]
    return F.concat(*lines, line("Content-Type", "text/html"), line("Content-Length", length.cast("string")), F.lit(END))


def records(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least_bytes: int = 0) -> DataFrame:
    """(record string): a WARC record for each row of ``pages``, without its ending.

    Of rows with equal payloads of ``least_bytes`` at least, that with the
    smallest id (then url) is a response and the others revisit it; rows with
    smaller payloads are all responses. A null payload is empty, a null id comes
    last. Rows alike in everything are a response and its revisits. Spaces and
    control characters are left out of urls.
    """
    flat = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page"), F.col(f"`{url_col}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{payload_col}`"), F.lit("")).alias("payload"),
    )
    flat = flat.withColumn("digest", F.sha1(F.col("payload").cast("binary"))).withColumn("bytes", F.octet_length("payload"))
    # nulls last: a flag goes before the id
    place = F.struct(F.col("page").isNull().alias("no_page"), "page", F.col("url").isNull().alias("no_url"), "url")
    large = flat.where(F.col("bytes") >= least_bytes)
    small = flat.where(F.col("bytes") < least_bytes).withColumn("digest", base32(F.col("digest")))
    whole = large.groupBy("digest").agg(F.min(F.struct(place.alias("at"), "payload")).alias("m"))
    responses = whole.select(
        "digest", F.col("m.at.page").alias("page"), F.col("m.at.url").alias("url"), F.col("m.payload").alias("payload")
    ).withColumn("digest", base32(F.col("digest")))
    heads = settled(large.groupBy("digest", "page", "url").agg(F.count("*").alias("n")))
    first = heads.groupBy(F.col("digest").alias("key")).agg(F.min(place).alias("first"))
    again = heads.join(first, F.col("digest") == F.col("key"))
    is_first = F.col("page").eqNullSafe(F.col("first.page")) & F.col("url").eqNullSafe(F.col("first.url"))
    again = again.withColumn("n", F.col("n") - is_first.cast("long")).where("n > 0")
    again = again.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).withColumn("digest", base32(F.col("digest")))
    body = F.concat(_header("response", F.octet_length("payload")), F.col("payload"))
    target = F.coalesce(F.col("first.page").cast("string"), F.lit(""))
    return (
        responses.select(body.alias("record"))
        .unionByName(small.select(body.alias("record")))
        .unionByName(again.select(_header("revisit", F.lit(0), target).alias("record")))
    )


def write(rows: DataFrame, path: str, archive_records: int = ARCHIVE_RECORDS) -> None:
    """Write records as gzipped archives below ``path``, ``archive_records`` to a file at most."""
    sink = rows.write.option("lineSep", END).option("maxRecordsPerFile", archive_records)
    sink.option("compression", "gzip").text(path)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and payload of each record of an archive, gzipped or plain."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        end = data.index(END.encode(), at)
        first, *lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        head = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        start = end + len(END)
        stop = start + int(head["content-length"])
        if data[stop : stop + len(END)] != END.encode():
            raise ValueError(f"the record at byte {at} has not the length it says")
        yield head, data[start:stop]
        at = stop + len(END)


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page", "type", "refers", "bytes", "digest", "stated"]
    for batch in batches:
        for content in batch.column(0):
            out: list[tuple] = []
            for head, payload in parse(content.as_py()):
                digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                stated = head["warc-payload-digest"].removeprefix("sha1:")
                revisit = head["warc-type"] == "revisit"
                if not revisit and digest != stated:
                    raise ValueError(f"payload of {head['warc-record-id']} does not have its digest")
                out.append((_page(head["warc-record-id"]), head["warc-type"], _page(head.get("warc-refers-to")), None if revisit else len(payload), digest, stated))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds], names)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the archives below ``path``.

    Each response's digest is computed anew. Revisits take size and digest of
    the response that they refer to.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    rows = settled(files.transform(in_arrow, _parsed, "page long, type string, refers long, bytes long, digest string, stated string"))
    responses = rows.where("type = 'response'")
    revisits = rows.where("type = 'revisit'").select("page", "refers", F.col("stated").alias("want"))
    sizes = responses.select(F.col("digest").alias("have"), "bytes").distinct()
    revisits = revisits.join(sizes, F.col("want") == F.col("have"), "left")
    return responses.select(
        F.col("page").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"),
    ).unionByName(
        revisits.select(
            F.col("page").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("have").alias("payload_digest"),
            F.lit("revisit").alias("record_type"), F.col("refers").alias("refers_to"),
        )
    )


def resolved(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as deduplicated archives to the shared folder and read them back."""
    spark = pages.sparkSession
    path = f"{scratch_dir(spark)}/warc-{uuid.uuid4().hex}"
    write(records(pages, id_col, url_col, payload_col, least_bytes), path)
    release(spark)
    return read(spark, path)
