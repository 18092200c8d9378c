"""WARC archives as a chunked record table.

Records are rows of (record, chunk number, bytes); a payload above ``CHUNK``
bytes is several rows, so no task ever holds more of a payload than a chunk
besides the row it came from. Every chunk row carries the digest of
the payload up to and with it, so the last one has the payload's own.

Archives are written and read by Spark's text source, line by line: a response's
HTTP message has chunked transfer coding, which frames every chunk, and a chunk
row is one "line" whatever bytes it holds. So archives can lie in any store
that Spark reaches, a lost task is repeated by Spark's committer, and both
directions stream. Files are gzip streams, which Spark reads whole and in order.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm.store import discard, remove, save, shared_path

CHUNK = 65_536           # bytes of a chunk

CHUNKS = ("record long, page_id long, url string, chunk int, last boolean, data binary, n_bytes long, framed long, "
          "sha1 binary, sha256 binary")
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"

#: Header lines of a WARC 1.1 record and of the HTTP messages inside.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_RESPONSE = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
HTTP_REVISIT = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
BODY_END = b"0\r\n\r\n"


def _frame(data: bytes) -> bytes:
    """A chunk in chunked transfer coding; the coding has no chunk of no bytes but the end."""
    return b"%x\r\n%b\r\n" % (len(data), data) if data else b""


def _digested(batches):
    """Add to every chunk row the length, framed length and digests of its payload so far.

    A record's rows follow one another; a digest is carried from row to row, the payload isn't.
    """
    record = length = framed = sha1 = sha256 = None
    for b in batches:
        rows = []
        for r, k, data in zip(*(b.column(c).to_pylist() for c in ("record", "chunk", "data"))):
            if k == 0:
                record, length, framed, sha1, sha256 = r, 0, 0, hashlib.sha1(), hashlib.sha256()
            elif r != record:
                raise ValueError("chunks of a record are out of order")
            length += len(data)
            framed += len(data) and len(data) + len(b"%x" % len(data)) + 4
            sha1.update(data)
            sha256.update(data)
            rows.append((length, framed, sha1.digest(), sha256.digest()))
        cols = list(zip(*rows)) or [()] * 4
        types = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, cols, types)],
                                         [*b.schema.names, "n_bytes", "framed", "sha1", "sha256"])


def chunk_table(pages: DataFrame, chunk: int = CHUNK, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """The chunked record table of ``pages``, written: :data:`CHUNKS`.

    ``record`` numbers the rows (pages may share ids or have none). Payloads
    are text (taken in UTF-8) or binary; null is empty: one chunk of no bytes.
    """
    payload = F.col(payload_col)
    if dict(pages.dtypes)[payload_col] != "binary":
        payload = F.encode(payload, "utf-8")
    rows = pages.select(F.monotonically_increasing_id().alias("record"), F.col(id_col).cast("long").alias("page_id"),
                        F.col(url_col).cast("string").alias("url"), F.coalesce(payload, F.lit(b"")).alias("payload"))
    last = F.greatest(F.lit(0), F.floor((F.octet_length("payload") - 1) / F.lit(chunk)).cast("int"))
    cut = (rows.withColumn("last_chunk", last)
           .select("*", F.explode(F.sequence(F.lit(0), F.col("last_chunk"))).alias("chunk"))
           .select("record", "page_id", "url", "chunk", (F.col("chunk") == F.col("last_chunk")).alias("last"),
                   F.substring("payload", F.col("chunk") * chunk + 1, F.lit(chunk)).alias("data")))
    return save(cut.mapInArrow(_digested, CHUNKS), "chunks", "zstd")


def originals(chunks: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``record, first, refers_to`` for every record: the record that holds its payload, and that record's page id.

    Payloads are equal when length, SHA-1 and SHA-256 are. The row of smallest
    page id is the original (null ids last; of several rows with that id, one).
    Payloads below ``least_bytes`` hold themselves. Copies combine before they
    are shuffled; only slim rows are joined back, and hot payloads among them
    are split by adaptive execution (the other side has one row a payload).
    """
    payload = ["n_bytes", "sha1", "sha256"]
    whole = chunks.filter("last").select("record", "page_id", *payload)
    order = F.struct(F.col("page_id").isNull(), "page_id", "record")
    firsts = (whole.filter(F.col("n_bytes") >= least_bytes).groupBy(*payload)
              .agg(F.min(order).alias("o"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
              .select(*payload, F.col("o.record").alias("first"), F.col("o.page_id").alias("refers_to")))
    return whole.join(firsts, payload, "left").select("record", F.coalesce("first", "record").alias("first"), "refers_to")


def _line_value(column: str) -> F.Column:
    """A text that can't end its header line."""
    text = F.coalesce(F.col(column), F.lit(""))
    for char, escaped in (("\r", "%0D"), ("\n", "%0A")):
        text = F.replace(text, F.lit(char), F.lit(escaped))
    return text


def _name(page_id: str, record: str) -> F.Column:
    """A record's name, which tells its page id."""
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(F.col(page_id).cast("string"), F.lit("")), F.lit(":"),
                    F.col(record).cast("string"), F.lit(">"))


def _base32_line(batches):
    """Heads (null chunk data) with their digest in base32 filled in."""
    for b in batches:
        heads = [h.replace("{digest}", base64.b32encode(d).decode()) for h, d in
                 zip(b.column("head").to_pylist(), b.column("sha1").to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column("record"), pa.array(heads, pa.string()), b.column("revisit")], ["record", "head", "revisit"])


def _lines(batches):
    """Archive lines of one partition: of every record its head row, then its chunk rows in order.

    A line is a chunk with its frame; Spark adds the LF that ends it. Payloads of revisits are left out.
    """
    revisit, head = False, b""
    for b in batches:
        out = []
        for h, is_revisit, last, data in zip(*(b.column(c).to_pylist() for c in ("head", "revisit", "last", "data"))):
            if h is not None:
                revisit, head = is_revisit, h.encode("utf-8")
                if revisit:
                    out.append(head + b"\r\n\r")
            elif not revisit:
                text = head + _frame(data) + (BODY_END + b"\r\n\r\n" if last else b"")
                out.append(text[:-1])
                head = b""
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["line"])


def write_archives(chunks: DataFrame, names: DataFrame, path: str, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write WARC 1.1 records of a chunked record table: ``response`` for originals, ``revisit`` for the rest.

    ``names``: see :func:`originals`. Head rows and chunk rows are dealt by
    record and sorted, so a record is consecutive lines of one file. A
    revisit keeps the payload's digest and length in its head, not its bytes.
    """
    about = (chunks.filter("last").select("record", "page_id", _line_value("url").alias("url"), "n_bytes", "framed", "sha1")
             .join(names, "record").withColumn("revisit", F.col("first") != F.col("record")))
    size = F.when(F.col("revisit"), F.lit(len(HTTP_REVISIT))).otherwise(F.col("framed") + len(HTTP_RESPONSE) + len(BODY_END))
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    common = [
        field("WARC-Record-ID", _name("page_id", "record")), field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", F.col("url")), field("WARC-Payload-Digest", F.lit("sha1:{digest}")),
        field("X-Payload-Length", F.col("n_bytes").cast("string")),
        field("Content-Type", F.lit("application/http; msgtype=response")), field("Content-Length", size.cast("string"))]
    start = F.lit("WARC/1.1\r\n")
    response = F.concat(start, F.lit("WARC-Type: response\r\n"), *common, F.lit("\r\n" + HTTP_RESPONSE))
    revisit = F.concat(start, F.lit("WARC-Type: revisit\r\n"), field("WARC-Profile", F.lit(REVISIT_PROFILE)),
                       field("WARC-Refers-To", _name("refers_to", "first")), *common, F.lit("\r\n" + HTTP_REVISIT))
    heads = (about.select("record", F.when(F.col("revisit"), revisit).otherwise(response).alias("head"), "revisit", "sha1")
             .mapInArrow(_base32_line, "record long, head string, revisit boolean"))
    none = lambda kind: F.lit(None).cast(kind)
    rows = heads.select("record", F.lit(-1).alias("chunk"), "head", "revisit", none("boolean").alias("last"), none("binary").alias("data"))
    rows = rows.unionByName(chunks.select("record", "chunk", none("string").alias("head"), none("boolean").alias("revisit"), "last", "data"))
    lines = rows.repartition("record").sortWithinPartitions("record", "chunk").mapInArrow(_lines, "line binary")
    # The cast keeps bytes as they are; a row limit per file would cut records.
    lines.select(F.col("line").cast("string").alias("value")).write.option("compression", "gzip").option("maxRecordsPerFile", 0).text(path)


def _page_id(name: str):
    """The page id in a record's name."""
    found = name.split(":")[-2]
    return int(found) if found else None


def _parse(batches):
    """Records of archive lines, one row each; whole files come in order, and a payload is digested as it passes.

    Raises ValueError where lengths, frames or digests don't fit.
    """
    def bad(what):
        return ValueError(f"WARC record {fields.get('warc-record-id')}: {what}")

    state, fields, left, sha1, length, need = "between", {}, 0, None, 0, 0
    for b in batches:
        out = []
        for line in b.column("line").to_pylist():
            if state in ("http", "size", "data", "end of body"):
                left -= len(line) + 1
                if left < 0:
                    raise bad("content is longer than Content-Length")
            if state == "data":
                if len(line) + 1 <= need:
                    sha1.update(line)
                    sha1.update(b"\n")
                    need -= len(line) + 1
                    length += len(line) + 1
                elif len(line) == need + 1 and line.endswith(b"\r"):
                    sha1.update(line[:-1])
                    length += need
                    state = "size"
                else:
                    raise bad("a chunk doesn't end where its length says")
            elif state == "size":
                need = int(line, 16)
                state = "data" if need else "end of body"
            elif state == "head":
                if line == b"\r":
                    left, sha1, length = int(fields["content-length"]), hashlib.sha1(), 0
                    state = "http"
                else:
                    key, _, value = line.decode("utf-8").partition(":")
                    fields[key.lower()] = value.strip()
            elif state == "between":
                if line == b"WARC/1.1\r":
                    state, fields = "head", {}
                elif line != b"\r":
                    raise bad("no record starts here")
            elif state == "http":
                if line == b"\r":
                    state = "size" if fields["warc-type"] == "response" else "done"
            elif state == "end of body":
                state = "done"
            if state == "done":
                if left:
                    raise bad("content is shorter than Content-Length")
                digest, size = fields["warc-payload-digest"].partition(":")[2], int(fields["x-payload-length"])
                whole = fields["warc-type"] == "response"
                if whole and (length != size or base64.b32encode(sha1.digest()).decode() != digest):
                    raise bad("the payload doesn't fit its digest")
                out.append((_page_id(fields["warc-record-id"]), size, digest, fields["warc-type"],
                            None if whole else _page_id(fields["warc-refers-to"])))
                state = "between"
        cols = list(zip(*out)) or [()] * 5
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, cols, types)),
                                         ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
    if state != "between":
        raise bad("the file ends inside a record")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives at ``path``: :data:`READ`.

    A response's length and digest are those of the bytes read, which must be
    those its head names; a revisit's are in its head.
    """
    return spark.read.text(path, lineSep="\n").select(F.col("value").cast("binary").alias("line")).mapInArrow(_parse, READ)


def archive_pages(pages: DataFrame, least_bytes: int = 0, chunk: int = CHUNK, path: str | None = None,
                  id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write a WARC record per row of ``pages``, read the archives back, one row per record.

    Of records with equal payloads of at least ``least_bytes`` the one of
    smallest page id is a response and the others revisit it; smaller ones are
    all responses. Null payloads are empty payloads. Of rows equal in id and
    payload one is the response, the rest revisit it; null ids come last and
    read back as null, null urls as empty; an empty table gives an empty
    result; other columns are ignored. ``path``: where the archives stay
    (a folder of the shared one if not given, removed after reading).
    """
    spark = pages.sparkSession
    chunks = chunk_table(pages, chunk, id_col, url_col, payload_col)
    target = path or shared_path(spark, "warc")
    write_archives(chunks, originals(chunks, least_bytes), target)
    back = save(read_archives(spark, target), "records")
    discard(chunks)
    if path is None:
        remove(spark, target)
    return back
