"""WARC archives with revisit resolution: headers are shuffled by payload digest, payloads are written once."""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import HOT_ROWS, hub_join, shared_path, stored, text_bytes

#: Payload bytes of one archive file, about. It is read back as a whole.
ARCHIVE_BYTES = 16 << 20
#: Id that stands for a null one where ids are compared: less than any other.
NO_ID = -(1 << 63)
CRLF = "\r\n"
HTTP_HEAD = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_SCHEMA = "record_id string, page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to_record string, refers_to long, payload binary"


def base32_sha1(text: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of the UTF-8 text: five hex digits make four base32 digits."""
    hexed = F.sha1(text)
    parts = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record_id(*of: Column) -> Column:
    h = F.md5(F.concat_ws("|", *[x.cast("string") for x in of]))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit("-"), part(13, 4), F.lit("-"), part(17, 4), F.lit("-"), part(21, 12), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, nothing for a null value. Line ends in a value are percent-encoded."""
    safe = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(CRLF)), F.lit(""))


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> str:
    """Writes one WARC record a page into new archives in the shared folder and returns their path.

    Of pages with equal payloads of at least `min_bytes` bytes the one with the largest id becomes a response,
    the others revisits of it; pages with smaller payloads are all responses. Only ids, addresses, digests and
    lengths are shuffled by digest; payloads move once, by a unique key, and a revisit's payload is not written.
    A null payload is an empty one; a null id counts as the smallest; of repeated rows (same id and payload) one
    keeps the role and the others revisit it; an empty table gives no records. A payload is written whole, however
    long. The archives are WARC 1.1 in UTF-8, each record a gzip member of its own, so a record can be read at its
    offset. Columns other than the three named don't matter. The id -2**63 stands for a null one.
    """
    spark = pages.sparkSession
    body = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("pid"),
        F.col(url_col).cast("string").alias("url"),
        body.alias("body"),
        F.octet_length(body).cast("long").alias("bytes"),
        base32_sha1(body).alias("digest"),
    )
    headers = stored(rows.select("pid", "url", "bytes", "digest"), "headers")
    total, n = headers.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count(F.lit(1))).first()
    leaders = headers.filter(F.col("bytes") >= min_bytes).groupBy("digest", "bytes").agg(F.max(F.struct("pid", "url")).alias("to"), F.count(F.lit(1)).alias("copies"))
    leaders = leaders.filter("copies > 1").select("digest", F.col("to.pid").alias("leader"), F.col("to.url").alias("leader_url"), "copies")
    key = F.concat_ws("|", F.col("pid").cast("string"), "digest")
    revisits = hub_join(headers.select("pid", "digest"), leaders, "digest", "copies", n).groupBy(key.alias("key")).agg(F.first("leader").alias("leader"), F.first("leader_url").alias("leader_url"))
    files = max(1, -(-(total + 600 * n) // ARCHIVE_BYTES))
    placed = rows.withColumn("key", key).repartition(files, "key").join(revisits.repartition(files, "key"), "key", "left")
    nth = F.row_number().over(Window.partitionBy("key").orderBy("url"))
    placed = placed.withColumn("nth", nth)
    is_revisit = F.col("leader").isNotNull() & ((F.col("leader") != F.col("pid")) | (F.col("nth") > 1))
    page = F.nullif(F.col("pid"), F.lit(NO_ID))
    response_head = F.concat(
        F.lit(f"Content-Type: application/http;msgtype=response{CRLF}"),
        _line("Content-Length", F.col("bytes") + len(HTTP_HEAD)),
    )
    revisit_head = F.concat(
        F.lit(f"WARC-Profile: {PROFILE}{CRLF}"),
        _line("WARC-Refers-To", _record_id(F.col("leader"), F.col("digest"), F.lit(1))),
        _line("WARC-Refers-To-Target-URI", F.col("leader_url")),
        F.lit(f"WARC-Refers-To-Date: {date}{CRLF}"),
        _line("X-Refers-To-Page", F.nullif(F.col("leader"), F.lit(NO_ID))),
        F.lit(f"Content-Type: application/http;msgtype=response{CRLF}"),
        F.lit(f"Content-Length: {len(HTTP_HEAD)}{CRLF}"),
    )
    record = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _line("WARC-Type", F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _record_id(F.col("pid"), F.col("digest"), F.col("nth"))),
        F.lit(f"WARC-Date: {date}{CRLF}"),
        _line("WARC-Target-URI", F.coalesce(F.col("url"), F.concat(F.lit("urn:x-page:"), page.cast("string")), F.lit("urn:x-page:none"))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit(CRLF)),
        _line("X-Page", page),
        F.when(is_revisit, revisit_head).otherwise(response_head),
        F.lit(CRLF + HTTP_HEAD),
        F.when(is_revisit, F.lit("")).otherwise(F.col("body")),
    )
    path = shared_path(spark, "warc")
    whole = F.concat(record, F.lit(CRLF * 2)).alias("value")
    placed.select(whole).mapInArrow(_members, "value string").write.option("lineSep", "\0").text(path)
    return path


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each record as a gzip member without its last byte, which the text writer adds as its line end.

    A member ends in its record's length, the highest byte last: 0 for records under 16 MB. A longer one, with an
    empty member behind it, ends in 0 too. The column is called a string, but its bytes are written as they are."""
    empty = gzip.compress(b"", mtime=0)

    def column(members: list[bytes]) -> pa.RecordBatch:
        ends = np.cumsum([0, *map(len, members)], dtype=np.int32)
        data = pa.Array.from_buffers(pa.string(), len(members), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(members))])
        return pa.RecordBatch.from_arrays([data], names=["value"])

    for batch in batches:
        held: list[bytes] = []
        size = 0
        for at in range(batch.num_rows):
            (data,) = text_bytes(batch.column(0).slice(at, 1))
            member = gzip.compress(data, 6, mtime=0)
            held.append((member if member[-1] == 0 else member + empty)[:-1])
            size += len(member)
            if size >= 8 << 20:
                yield column(held)
                held, size = [], 0
        if held:
            yield column(held)


def archive_members(data: bytes) -> Iterator[bytes]:
    """The contents of an archive's gzip members, one by one, in time linear in the archive's size."""
    at, end = 0, len(data)
    while at < end:
        member, out = zlib.decompressobj(31), []
        while not member.eof:
            if at >= end:
                raise ValueError("an archive ends in the middle of a gzip member")
            part = data[at : at + 4096]
            out.append(member.decompress(part))
            at += len(part) - len(member.unused_data)
        yield b"".join(out)


def parse_archive(data: bytes) -> Iterator[dict]:
    """The records of one archive, found by their Content-Length; a broken one is an error."""
    at, end = 0, len(data)
    while at < end:
        stop = data.find(b"\r\n\r\n", at)
        lines = data[at:stop].split(b"\r\n") if stop >= 0 else [b""]
        if lines[0] != b"WARC/1.1":
            raise ValueError(f"no WARC record at byte {at}")
        head = dict(x.split(b": ", 1) for x in lines[1:])
        begin = stop + 4
        at = begin + int(head[b"Content-Length"])
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"a WARC record of wrong length ends at byte {at}")
        payload = data[data.index(b"\r\n\r\n", begin, at) + 4 : at]
        at += 4
        text = {k.decode(): v.decode() for k, v in head.items()}
        number = lambda k: int(text[k]) if k in text else None  # noqa: E731, B023
        response = text["WARC-Type"] == "response"
        if response and base64.b32encode(hashlib.sha1(payload).digest()).decode() != text["WARC-Payload-Digest"].removeprefix("sha1:"):
            raise ValueError(f"the payload of {text['WARC-Record-ID']} doesn't match its digest")
        yield {
            "record_id": text["WARC-Record-ID"],
            "page_id": number("X-Page"),
            "url": text["WARC-Target-URI"],
            "record_type": text["WARC-Type"],
            "payload_digest": text["WARC-Payload-Digest"].removeprefix("sha1:"),
            "payload_bytes": len(payload) if response else None,
            "refers_to_record": text.get("WARC-Refers-To"),
            "refers_to": number("X-Refers-To-Page"),
            "payload": payload if response else None,
        }


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of all archives under `path`, with digests and lengths of the payloads as read.

    Revisits have a null payload and length; `resolve_revisits` joins them to their responses."""
    names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
    names = names if payloads else names[:-1]
    schema = READ_SCHEMA if payloads else READ_SCHEMA.rpartition(", ")[0]
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}
    arrow = pa.schema([(n, kinds.get(n, pa.string())) for n in names])

    def parse(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                rows, size = [], 0
                for member in archive_members(batch.column(0)[i].as_py()):
                    for r in parse_archive(member):
                        rows.append({n: r[n] for n in names})
                        size += len(r["payload"] or b"") if payloads else 1
                    if len(rows) >= 1000 or size > 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, arrow)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(parse, schema)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """records with each revisit's length (and payload, if there) taken from the response it refers to.

    Responses stay as they are. A response to which very many records refer is dealt to several places, each for
    about HOT_ROWS of its revisits, so none is a task of its own. A revisit of nothing, or of a record that isn't
    there, keeps its nulls. An empty table gives an empty result."""
    more = [c for c in ("payload_bytes", "payload") if c in records.columns]
    records = stored(records, "records")
    own = records.filter("record_type = 'response' or refers_to_record is null")
    revisits = records.filter("record_type <> 'response' and refers_to_record is not null")
    asked = stored(revisits.groupBy("refers_to_record").agg(F.count(F.lit(1)).alias("_n")), "asked")
    places = F.ceil(F.col("_n") / HOT_ROWS).cast("int")
    dealt = hub_join(revisits, asked, "refers_to_record", "_n", revisits.count()).withColumn("_place", F.pmod(F.xxhash64("record_id"), places)).drop("_n")
    answers = records.filter("record_type = 'response'").select(F.col("record_id").alias("refers_to_record"), *[F.col(c).alias(f"_{c}") for c in more])
    answers = answers.join(asked, "refers_to_record").withColumn("_place", F.explode(F.sequence(F.lit(0).cast("long"), places.cast("long") - 1))).drop("_n")
    joined = dealt.join(answers, ["refers_to_record", "_place"], "left")
    return own.unionByName(joined.select(*[F.coalesce(c, f"_{c}").alias(c) if c in more else F.col(c) for c in records.columns]))
