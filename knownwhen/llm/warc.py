"""WARC archives through a chunked record table.

1. ``chunks``: a payload becomes rows (record, chunk) of at most ``CHUNK`` bytes,
   each with these bytes and with the length and the SHA-1 of the payload up to there.
   They are cut out of the batch that Spark hands over, so that Python holds some
   chunks at a time and never a copy of a whole payload; all later steps see chunks.
2. Of records with equal payloads of ``LEAST`` bytes or more, the one with the
   largest id is the response, the others are revisits of it. This is decided on
   ids, lengths and digests alone, in a chunk table without the bytes.
3. ``write``: every chunk is one WARC record. The chunks after the first are
   ``continuation`` records of a segmented record (WARC 1.1, section 6.9), so they
   may lie in any order and file. Spark's text writer puts the records into
   (compressed) files, with the blank lines between records as its line separator.
4. ``read``: files are split at the head lines of records and read in parallel.
   Chunks of one record are put in order and digested one after the other.

No chunk holds the head line of a record, since a payload is always cut inside
such a text, so that splitting is exact for any payload.

Defined results: a null payload is an empty one. A null id makes a response that
nothing refers to. Rows that repeat both id and payload are treated alike, so all
of them are responses if that id is the largest.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from knownwhen.llm import frames as fr
from knownwhen.llm import text as tx
from knownwhen.sources.shared import new_folder

CHUNK = 1 << 18
LEAST = 1000
HEAD = b"WARC/1.1\r\n"
BLANK = "\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_CHUNKS = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("copy", pa.int64()), ("chunk", pa.int32()),
    ("last", pa.bool_()), ("bytes_so_far", pa.int64()), ("sha1_so_far", pa.string()),
    ("total", pa.int64()), ("digest", pa.string()), ("data", pa.binary())])
_CHUNKS_SQL = ("page_id long, url string, copy long, chunk int, last boolean, bytes_so_far long, "
               "sha1_so_far string, total long, digest string, data binary")
_READ = ("record string, segment int, page_id long, record_type string, refers_to long, "
         "payload_bytes long, payload_digest string, part binary")


def cut(data: bytes | memoryview, size: int = CHUNK) -> Iterator[bytes | memoryview]:
    """Parts of at most ``size`` bytes, none of which holds a record's head line."""
    begin = 0
    for found in [*re.finditer(re.escape(HEAD), data), None]:
        stop = found.start() + 3 if found else len(data)
        while stop - begin > size:
            yield data[begin:begin + size]
            begin += size
        if found is None or stop > begin:
            yield data[begin:stop]
            begin = stop


def chunk_rows(data: bytes | memoryview, size: int = CHUNK) -> Iterator[dict]:
    """The rows of one record, with what is known of the payload so far and of the whole."""
    whole = hashlib.sha1(data).hexdigest()
    digest, length = hashlib.sha1(), 0
    for number, part in enumerate(cut(data, size)):
        length += len(part)
        last = length == len(data)
        if not last:
            digest.update(part)
        yield {"chunk": number, "last": last, "bytes_so_far": length,
               "sha1_so_far": whole if last else digest.hexdigest(),
               "total": len(data), "digest": whole, "data": part}


def chunks(pages: DataFrame, size: int = CHUNK, with_data: bool = True) -> DataFrame:
    """The chunked record table of (page_id, url, binary payload).

    ``copy`` tells rows apart that repeat both id and payload.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copy = TaskContext.get().partitionId() << 33
        out: dict[str, list] = {n: [] for n in _CHUNKS.names}
        held = 0
        for batch in batches:
            payloads = batch.column(2)
            for i, (page_id, url) in enumerate(zip(batch.column(0).to_pylist(),
                                                   batch.column(1).to_pylist())):
                copy += 1
                for row in chunk_rows(memoryview(payloads[i].as_buffer()), size):
                    row |= {"page_id": page_id, "url": url, "copy": copy,
                            "data": bytes(row["data"]) if with_data else None}
                    for name, values in out.items():
                        values.append(row[name])
                    held += 256 + (len(row["data"]) if with_data else 0)
                    if held >= 4 * size:
                        yield pa.RecordBatch.from_pydict(out, schema=_CHUNKS)
                        out, held = {n: [] for n in _CHUNKS.names}, 0
        yield pa.RecordBatch.from_pydict(out, schema=_CHUNKS)

    return pages.mapInArrow(run, _CHUNKS_SQL)


def revisits(table: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, digest, to_page): the records that only refer to another one."""
    whole = table.filter("last and page_id is not null").filter(
        F.col("bytes_so_far") >= least).select("page_id", F.col("sha1_so_far").alias("digest"))
    latest = whole.groupBy("digest").agg(
        F.max("page_id").alias("to_page"), F.min("page_id").alias("least_page"))
    latest = latest.filter("least_page < to_page").drop("least_page")
    return whole.join(latest, "digest").filter("page_id < to_page").distinct()


def write(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
          payload_col: str = "html", size: int = CHUNK, least: int = LEAST,
          compression: str = "gzip") -> str:
    """Write the archives to the shared folder; returns their path."""
    spark = pages.sparkSession
    fr.bounded_batches(spark)
    escaped = F.col(url_col).cast("string")
    for code in [*range(33), 127]:  # what would end a header line or a word of it
        escaped = F.replace(escaped, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), escaped.alias("url"),
                        F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"))
    known = chunks(rows, size, with_data=False).select(
        "page_id", "last", "bytes_so_far", "sha1_so_far")
    away = revisits(fr.stored(known, "warc-chunks"), least).select(
        F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "to_page")
    table = chunks(rows, size)
    decided = table.join(away, (table["page_id"] == away["_page"])
                         & (table["digest"] == away["_digest"]), "left")
    decided = decided.filter("to_page IS NULL OR chunk = 0")  # a revisit has a head only
    path = new_folder(spark, "warc")
    lines = decided.select(_record().cast("string").alias("value"))
    lines.write.options(lineSep=BLANK, compression=compression).text(path)
    return path


def _name(page: str, chunk: Column) -> Column:
    number = F.coalesce(F.col(page).cast("string"), F.lit(""))
    return F.concat(F.lit("<urn:page:"), number, F.lit(":"), F.col("digest"), F.lit(":"),
                    chunk.cast("string"), F.lit(">"))


def _record() -> Column:
    """The WARC record of a chunk without the blank lines that end it, as bytes."""
    revisit, first, last = F.col("to_page").isNotNull(), F.col("chunk") == 0, F.col("last")
    segment = ~revisit & ~(first & last)
    body = F.when(revisit, F.lit(b"")).when(
        first, F.concat(F.lit(HTTP), F.col("data"))).otherwise(F.col("data"))

    def line(field: str, value: Column | str, where: Column | None = None) -> Column:
        """A header line, null (and left out) where it doesn't apply."""
        text = F.concat(F.lit(f"{field}: "), F.lit(value))
        return text if where is None else F.when(where, text)

    head = F.concat_ws(
        "\r\n", F.lit(HEAD.decode().strip()),
        line("WARC-Type", F.when(revisit, "revisit").when(first, "response")
             .otherwise("continuation")),
        line("WARC-Record-ID", _name("page_id", F.col("chunk"))),
        line("WARC-Date", DATE),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")), first),
        line("X-Payload-Length", F.col("total").cast("string"), first),
        line("WARC-Profile", PROFILE, revisit),
        line("WARC-Refers-To", _name("to_page", F.lit(0)), revisit),
        line("WARC-Segment-Number", (F.col("chunk") + 1).cast("string"), segment),
        line("X-Copy", F.col("copy").cast("string"), segment),
        line("WARC-Segment-Origin-ID", _name("page_id", F.lit(0)), ~first),
        line("WARC-Segment-Total-Length", (F.col("total") + len(HTTP)).cast("string"),
             segment & last),
        line("Content-Type", "application/http; msgtype=response", first),
        line("Content-Length", F.octet_length(body).cast("string")))
    return F.concat(head.cast("binary"), F.lit(BLANK.encode()), body)


def parsed(line: bytes) -> tuple[dict[str, str], bytes]:
    """The head and the body of a record, as it lies between two head lines."""
    head, _, rest = line.removeprefix(HEAD).partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n"))
    return fields, rest[:int(fields["Content-Length"])]


def _page(name: str) -> int | None:
    number = name.split(":")[2]
    return int(number) if number else None


def read(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record.

    Lengths and digests of responses are taken from the payloads that are read; those of
    revisits, whose payload lies elsewhere, from their heads.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in tx.slices(batches, 32):
            yield pa.RecordBatch.from_pylist(
                [_row(*parsed(line)) for line in rows["value"] if line], schema=_read_schema())

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict | None = None  # the record whose segments are being read, in order
        digest = hashlib.sha1()
        for rows in tx.slices(batches, 32):
            out = []
            for i in range(len(rows["record"])):
                row = {k: rows[k][i] for k in rows}
                if held is None or row["record"] != held["record"]:
                    if held:
                        out.append(held | {"payload_digest": digest.hexdigest()})
                    held, digest = row | {"payload_bytes": 0, "part": None}, hashlib.sha1()
                digest.update(row["part"])
                held["payload_bytes"] += len(row["part"])
            yield pa.RecordBatch.from_pylist(out, schema=_read_schema())
        if held:
            yield pa.RecordBatch.from_pylist([held | {"payload_digest": digest.hexdigest()}],
                                             schema=_read_schema())

    lines = spark.read.option("lineSep", BLANK + HEAD.decode()).text(path)
    found = lines.select(F.col("value").cast("binary").alias("value")).mapInArrow(run, _READ)
    parts = found.filter("segment is not null").repartition("record").sortWithinPartitions(
        "record", "segment").mapInArrow(joined, _READ)
    return found.filter("segment is null").union(parts).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _read_schema() -> pa.Schema:
    return pa.schema([("record", pa.string()), ("segment", pa.int32()),
                      ("page_id", pa.int64()), ("record_type", pa.string()),
                      ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
                      ("payload_digest", pa.string()), ("part", pa.binary())])


def _row(head: dict[str, str], body: bytes) -> dict:
    name, kind = head["WARC-Record-ID"], head["WARC-Type"]
    payload = body.removeprefix(HTTP) if kind == "response" else body
    origin = head.get("WARC-Segment-Origin-ID", name)
    row = {"record": f"{origin}{head.get('X-Copy', '')}", "page_id": _page(name),
           "record_type": "response" if kind == "continuation" else kind}
    if "WARC-Segment-Number" in head:
        return row | {"segment": int(head["WARC-Segment-Number"]), "part": payload}
    if kind == "revisit":
        return row | {"refers_to": _page(head["WARC-Refers-To"]),
                      "payload_bytes": int(head["X-Payload-Length"]),
                      "payload_digest": head["WARC-Payload-Digest"].removeprefix("sha1:")}
    return row | {"payload_bytes": len(payload),
                  "payload_digest": hashlib.sha1(payload).hexdigest()}


def archived(pages: DataFrame, **columns) -> DataFrame:
    """Write all pages as archives and read them back."""
    return read(pages.sparkSession, write(pages, **columns))
