"""WARC as a content-addressed archive.

Two tables: ``payloads`` has each distinct payload once, under its SHA-256,
which is recomputed from the bytes whenever they are read; ``headers`` has one row per
record with the exact header lines (WARC/1.1 and HTTP) and the address of its
payload.  A join on the address gives the original records back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierstat.llm.common import written
from tierstat.session import scratch_path

MOST_NAMES = 4096  # names joined by broadcast, at most
LEAST_REVISIT = 1000  # payload bytes from which equal payloads are stored as revisits
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EOL = "\r\n"


@dataclass(frozen=True)
class Archive:
    """Paths of the two tables."""

    headers: str
    payloads: str


def _line(name: str, value: Column) -> Column:
    """One header line, or nothing if the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(EOL)), F.lit(""))


def _uuid(*parts: Column) -> Column:
    """Record id made from ``parts``, so that a revisit can name a response without a join."""
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("none")) for p in parts]))
    cuts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def write_archive(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", path: str | None = None
) -> Archive:
    """Write one record per row of ``pages`` under ``path`` (default: a new folder in the shared one).

    The payload is the html in UTF-8 (null: empty).  Of records with equal
    payloads of ``LEAST_REVISIT`` bytes or more, that with the largest id is
    the response and the others revisit it (rows repeating that id too are
    responses; without any id all are).  Shorter ones are all responses.
    """
    root = path or scratch_path(pages.sparkSession, "warc")
    archive = Archive(f"{root}/headers", f"{root}/payloads")
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("address", F.sha2("payload", 256))
    rows.select("address", "payload").dropDuplicates(["address"]).write.parquet(archive.payloads)

    narrow = rows.select("page_id", "url", "address", F.length("payload").alias("bytes"), F.sha1("payload").alias("sha1"))
    largest = narrow.where(F.col("bytes") >= LEAST_REVISIT).groupBy("address").agg(F.max("page_id").alias("original"))
    linked = narrow.join(largest, "address", "left")
    revisit = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    linked = linked.withColumn("revisit", revisit)
    stored = F.when(F.col("revisit"), 0).otherwise(F.col("bytes"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "),
        F.col("bytes").cast("string"), F.lit(EOL + EOL),
    )
    target = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    header = F.concat(
        F.lit(f"WARC/1.1{EOL}"),
        _line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        _line("WARC-Record-ID", _uuid(F.col("page_id"), F.col("address"))),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", target),
        _line("WARC-Page-ID", F.col("page_id").cast("string")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(
            F.col("revisit"),
            F.concat(
                _line("WARC-Refers-To", _uuid(F.col("original"), F.col("address"))),
                _line("WARC-Refers-To-Page-ID", F.col("original").cast("string")),
                _line("WARC-Profile", F.lit(PROFILE)),
            ),
        ).otherwise(""),
        _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("Content-Length", (F.length("http") + stored).cast("string")),
        F.lit(EOL),
    )
    linked.withColumn("http", http).select("address", header.alias("header"), "http").write.parquet(archive.headers)
    return archive


def field(name: str) -> Column:
    """The value of a header line of the record, null if it has none."""
    found = F.regexp_extract("header", f"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """Rows (header, http, payload, record), one per record.

    ``record`` has the record's bytes as a WARC file holds them (a revisit
    carries no payload; ``payload`` is that of the response it names).  A
    payload whose bytes no longer give its address stops the query, and so does a record whose
    payload is not there.
    """
    headers = spark.read.schema("address string, header string, http string").parquet(archive.headers)
    payloads = spark.read.schema("address string, payload binary").parquet(archive.payloads)
    # Each stored payload is verified once, not once for every record that holds it.
    fault = F.raise_error(F.concat(F.lit("damaged or missing payload "), F.col("address"))).cast("binary")
    sound = F.when(F.sha2("payload", 256) == F.col("address"), F.col("payload")).otherwise(fault)
    stored = payloads.select("address", sound.alias("payload"), F.lit(True).alias("stored"))
    joined = headers.join(stored, "address", "left")
    checked = F.when(F.col("stored"), F.col("payload")).otherwise(fault)
    body = F.when(field("WARC-Type") == "revisit", F.lit(b"")).otherwise(checked)
    record = F.concat(F.encode("header", "UTF-8"), F.encode("http", "UTF-8"), body, F.lit(b"\r\n\r\n"))
    return joined.withColumn("payload", checked).select("header", "http", "payload", record.alias("record"))


def archived_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write ``pages`` to an archive, read it back: (page_id, payload_bytes, payload_digest, record_type, refers_to).

    Figures come from the archive's own header lines and from the payload that is cut out of each rebuilt
    record by its lengths; a revisit has those of the response it names.  A record whose lengths or payload digest do not
    fit its bytes stops the query, and so does a revisit of no response.
    """
    kind = pages.schema[page_id].dataType
    back = read_archive(pages.sparkSession, write_archive(pages, page_id, url, html))
    revisit = field("WARC-Type") == "revisit"
    block = field("Content-Length").cast("long")
    size = F.when(revisit, 0).otherwise(F.regexp_extract("http", f"{EOL}Content-Length: ([0-9]+){EOL}", 1).cast("long"))
    start = F.octet_length("header") + block - size + 1
    cut = F.substring("record", start.cast("int"), size.cast("int"))
    whole = (F.octet_length("record") == F.octet_length("header") + block + 4) & (block == F.octet_length("http") + size)
    sound = whole & (revisit | (F.concat(F.lit("sha1:"), F.sha1(cut)) == field("WARC-Payload-Digest")))
    fault = F.raise_error(F.concat(F.lit("damaged record "), F.coalesce(field("WARC-Record-ID"), F.lit("without id"))))
    records = written(
        back.select(
            field("WARC-Page-ID").cast(kind).alias("page_id"),
            F.when(revisit, None).when(sound, F.octet_length(cut)).otherwise(fault.cast("int")).cast("long").alias("payload_bytes"),
            F.when(revisit & sound, None).when(sound, F.sha1(cut)).otherwise(fault.cast("string")).alias("payload_digest"),
            field("WARC-Type").alias("record_type"),
            field("WARC-Refers-To-Page-ID").cast(kind).alias("refers_to"),
            field("WARC-Record-ID").alias("id"),
            field("WARC-Refers-To").alias("named"),
        ),
        "records",
    )
    # Records that share an id have the same payload.
    responses = records.where("record_type = 'response'").dropDuplicates(["id"])
    responses = responses.select(F.col("id").alias("named"), F.col("payload_bytes").alias("bytes"), F.col("payload_digest").alias("digest"))
    return _named_figures(records, responses)


def _named_figures(records: DataFrame, responses: DataFrame) -> DataFrame:
    """``records`` with each revisit's figures taken from the response it names (``responses``: named, bytes, digest).

    Names that hold more than a 4096th part of all revisits, which can be 4096 at most, are joined by broadcast, the others by
    a shuffle in which no name is large: revisits of one payload never meet in one task.
    """
    own = records.where("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    revisits = records.where("record_type <> 'response'").select("page_id", "record_type", "refers_to", "id", "named")
    counts = written(revisits.groupBy("named").agg(F.count(F.lit(1)).alias("n")), "named")
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = counts.where(F.col("n") * MOST_NAMES > total).select("named")
    known = F.broadcast(often.join(responses, "named", "left"))
    lost = F.raise_error(F.concat(F.lit("no response for the revisit "), F.col("id")))
    parts = [revisits.join(known, "named"), revisits.join(F.broadcast(often), "named", "left_anti").join(responses, "named", "left")]
    for part in parts:
        own = own.unionByName(part.select(
            "page_id", F.coalesce("bytes", lost.cast("long")).alias("payload_bytes"),
            F.coalesce("digest", lost.cast("string")).alias("payload_digest"), "record_type", "refers_to",
        ))
    return own
