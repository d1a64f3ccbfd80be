"""WARC archives: written record by record, read back by verifying the chain of record boundaries.

Reading does not trust the record mark. Every place where the mark occurs is a
candidate; its task parses the header there and emits where the next record
would begin. Pointer jumping from the start of each file keeps the candidates
that the chain reaches; a mark inside a payload is never reached, and its bytes
go back to the record around it.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchstrata.llm.common import small, text_bytes
from matchstrata.session import stage

MARK = "WARC/1.0\r\n"
LEAST_REVISIT_BYTES = 100
DATE = "2024-01-01T00:00:00Z"
_END = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def write_archives(
    pages: DataFrame,
    path: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least: int = LEAST_REVISIT_BYTES,
) -> None:
    """Write a record for each page, one archive for each input partition.

    Of pages with one payload of at least ``least`` bytes that with the smallest
    id is the response (and so are repeated rows of it), the others revisit it.
    Pages without id revisit as well, or are responses if none of the group has
    one. A null page is an empty payload, a null address an empty one; line ends
    within an address are left out. Other columns are not looked at.

    Spark's text writer ends each row with the blank lines that end a record.
    """
    payload_text = F.coalesce(F.col(html), F.lit(""))
    payload = F.encode(payload_text, "UTF-8")
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.regexp_replace(F.coalesce(F.col(url).cast("string"), F.lit("")), r"[\r\n]", "").alias("url"),
        payload_text.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(payload, 256).alias("payload_digest"),
    )
    shared = stage(
        rows.where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n"),
        "payloads",
    )
    joined = rows.join(small(shared.df), "payload_digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "),
        F.col("payload_bytes"),
        F.lit(_END),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    header = F.concat(
        F.lit(MARK + "WARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "),
        name(F.col("page_id")),
        F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "),
        F.col("url"),
        F.lit("\r\nWARC-Payload-Digest: sha256:"),
        F.col("payload_digest"),
        F.when(
            revisit,
            F.concat(F.lit(f"\r\nWARC-Profile: {_PROFILE}\r\nWARC-Refers-To: "), name(F.col("first_id"))),
        ).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(F.encode(block, "UTF-8")),
    )
    joined.select(F.concat(header, F.lit(_END), block).alias("value")).write.option("lineSep", _END).text(path)
    shared.discard()


_FIELD = re.compile(rb"^([A-Za-z-]+):[ \t]*(.*?)[ \t]*\r?$", re.M)
_LINE_SCHEMA = (
    "file string, split long, place long, before long, length long, record_type string, target_uri string, "
    "record_id string, refers_to string, payload_digest string, head long, block_bytes long, data binary"
)


def _parse(line: bytes) -> tuple:
    """What a header says; nulls where this is no header."""
    head, end, _ = line.partition(b"\r\n\r\n")
    fields = {k.lower(): v for k, v in _FIELD.findall(head)} if end else {}
    block = fields.get(b"content-length", b"")
    if not block.isdigit() or len(block) > 15:
        return (None,) * 7
    text = lambda k: fields[k].decode("utf-8", "replace") if k in fields else None
    return (
        text(b"warc-type"),
        text(b"warc-target-uri"),
        text(b"warc-record-id"),
        text(b"warc-refers-to"),
        text(b"warc-payload-digest"),
        len(head) + 4,
        int(block),
    )


def _candidates(spark: SparkSession, path: str, data: bool) -> DataFrame:
    """A row for each piece of a file that begins with the mark (or with the file).

    ``before`` counts the bytes of the same split before the piece's text. Pieces
    come from Spark's text reader with the mark as line end, so large files are
    read in splits.
    """
    lines = (
        spark.read.option("lineSep", MARK)
        .text(path)
        .select(
            F.col("value").cast("binary").alias("value"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
        )
    )
    names = [c.split()[0] for c in _LINE_SCHEMA.split(", ")]
    mark = len(MARK)

    def run(batches):
        at, place, before = None, 0, 0
        for batch in batches:
            rows = []
            for value, file, split in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (file, split) != at:
                    at, place, before = (file, split), 0, 0
                rows.append((file, split, place, before, len(value), *_parse(value), value if data else None))
                place += 1
                before += len(value) + mark
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names=names
                )

    return lines.mapInArrow(run, _LINE_SCHEMA)


_TYPES = [pa.string(), *[pa.int64()] * 4, *[pa.string()] * 5, pa.int64(), pa.int64(), pa.binary()]


def _with_start(pieces: DataFrame, splits: DataFrame) -> DataFrame:
    """Adds ``start``: the place in the file where a piece's mark begins."""
    return pieces.join(splits, ["file", "split"]).withColumn(
        "start", F.col("split_start") + F.col("before") - len(MARK)
    )


def reachable(candidates: DataFrame) -> DataFrame:
    """``file, start`` of the candidates that the chain from the file's start reaches.

    ``candidates`` has ``file, start, next``. After round k every reached
    candidate within 2^k steps is known, and each pointer skips 2^k records.
    """
    first = candidates.groupBy("file").agg(F.min("start").alias("start"))
    known = stage(first, "reached")
    jumps = stage(candidates.where("next IS NOT NULL").select("file", "start", "next"), "jumps")
    while not jumps.df.isEmpty():
        hop = jumps.df
        landed = known.df.join(hop, ["file", "start"]).select("file", F.col("next").alias("start"))
        landed = landed.join(candidates.select("file", "start"), ["file", "start"], "left_semi")
        more = stage(known.df.unionByName(landed).distinct(), "reached")
        then = hop.select("file", F.col("start").alias("next"), F.col("next").alias("then"))
        longer = stage(hop.join(then, ["file", "next"]).select("file", "start", F.col("then").alias("next")), "jumps")
        known.discard()
        jumps.discard()
        known, jumps = more, longer
    jumps.discard()
    return known.df


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records under ``path``: ``file, start, record_type, target_uri, record_id, refers_to,
    payload_digest`` as their headers say, ``block`` (its declared bytes) and ``payload`` (binary:
    the block after its HTTP header).

    A file ends at the first record whose header is broken or whose block runs
    past the end; a file that does not begin with the mark gives no records.
    """
    slim = stage(_candidates(spark, path, data=False).drop("data"), "boundaries").df
    order = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # a row per split
    sizes = slim.groupBy("file", "split").agg(F.sum(F.col("length") + len(MARK)).alias("n"))
    splits = stage(
        sizes.select("file", "split", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("split_start")), "splits"
    ).df
    # Stored, as the starts of splits are, so that Catalyst knows their size: a row per file.
    ends = stage(sizes.groupBy("file").agg((F.sum("n") - len(MARK)).alias("file_end")), "file-ends").df
    placed = _with_start(slim, splits).join(ends, "file")
    after = F.col("start") + len(MARK) + F.col("head") + F.col("block_bytes")
    candidates = stage(
        placed.where("start >= 0").select(
            "file",
            "split",
            "start",
            F.when(after <= F.col("file_end"), after + len(_END)).alias("next"),
            (F.col("length") >= F.col("head") + F.col("block_bytes")).alias("whole"),
        ),
        "candidates",
    ).df
    # A chain begins at byte 0, and nowhere else.
    begun = stage(candidates.where("start = 0").select("file"), "begun-files").df
    known = reachable(candidates.join(begun, "file", "left_semi")).withColumn("record", F.lit(True))
    flagged = _owned(candidates.join(known, ["file", "start"], "left"))
    # Marks inside a payload, and the records around them.
    owned = stage(
        flagged.where("record IS NULL AND start < owner_next AND NOT owner_whole").select(
            "file", F.col("start").alias("inner"), F.col("owner").alias("start")
        ),
        "inside",
    ).df
    rejected = stage(
        flagged.where("record IS NULL OR next IS NULL").select("file", "start", F.lit(True).alias("rejected")),
        "rejected",
    ).df

    pieces = _with_start(_candidates(spark, path, data=True), splits).where("start >= 0")
    pieces = pieces.join(small(rejected), ["file", "start"], "left")
    records = pieces.where("rejected IS NULL")
    if owned.isEmpty():
        records = records.withColumn("rest", F.lit(None).cast("binary"))
    else:
        records = records.join(_merged(pieces, owned), ["file", "start"], "left")
    data = F.when(F.col("rest").isNull(), F.col("data")).otherwise(F.concat("data", "rest"))
    block = F.substring(data, F.col("head").cast("int") + 1, F.col("block_bytes").cast("int"))
    # The HTTP header ends at its first blank line; Latin-1 keeps one character for each byte.
    http = F.locate(_END, F.decode(block, "ISO-8859-1"))
    return records.select(
        "file",
        "start",
        "record_type",
        "target_uri",
        "record_id",
        "refers_to",
        F.regexp_replace("payload_digest", "^sha256:", "").alias("payload_digest"),
        block.alias("block"),
        F.when(http > 0, F.substring(block, http + len(_END), F.octet_length(block))).otherwise(block).alias("payload"),
    )


def _owned(flagged: DataFrame) -> DataFrame:
    """Adds the last reached record at or before each candidate: ``owner, owner_next, owner_whole``.

    Looked for in the candidate's own split, else in the splits before, of which
    only the last record counts.
    """
    here = F.when(F.col("record"), F.struct("start", "next", "whole"))
    upto = Window.partitionBy("file", "split").orderBy("start")
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    lasts = flagged.groupBy("file", "split").agg(F.max(here).alias("last"))  # a row per split
    carried = stage(lasts.select("file", "split", F.max("last").over(earlier).alias("carried")), "carried-records").df
    owner = F.coalesce(F.last(here, ignorenulls=True).over(upto), F.col("carried"))
    return (
        flagged.join(carried, ["file", "split"])
        .withColumn("__owner", owner)
        .withColumns(
            {
                "owner": F.col("__owner.start"),
                "owner_next": F.col("__owner.next"),
                "owner_whole": F.coalesce(F.col("__owner.whole"), F.lit(False)),
            }
        )
        .drop("__owner", "carried")
    )


def _merged(pieces: DataFrame, owned: DataFrame) -> DataFrame:
    """For each record around marks: what follows its own piece, marks included."""
    parts = pieces.select("file", F.col("start").alias("inner"), "data").join(small(owned), ["file", "inner"])
    mark = F.lit(MARK).cast("binary")
    return stage(
        parts.groupBy("file", "start")
        .agg(F.sort_array(F.collect_list(F.struct("inner", "data"))).alias("parts"))
        .select(
            "file",
            "start",
            F.aggregate(
                "parts", F.lit("").cast("binary"), lambda done, p: F.concat(done, mark, p["data"])
            ).alias("rest"),
        ),
        "payload-parts",
    ).df


def page_of(name: str) -> Column:
    """The page id of a record id that ``write_archives`` gave."""
    return F.regexp_extract(name, r"^<urn:page:(-?\d*)>$", 1).try_cast("long")


def page_records(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of archives of pages.

    A response's size and digest are those of the payload read; a revisit has no
    payload and takes the digest of its header, and the size its HTTP header gives.
    """
    revisit = F.col("record_type") == "revisit"
    told = F.regexp_extract(F.decode("block", "ISO-8859-1"), r"(?i)\r\nContent-Length: *(\d+)\r\n", 1)
    size = F.when(revisit, told.try_cast("long")).otherwise(F.octet_length("payload").cast("long"))
    return records.select(
        page_of("record_id").alias("page_id"),
        size.alias("payload_bytes"),
        F.when(revisit, F.col("payload_digest")).otherwise(F.sha2("payload", 256)).alias("payload_digest"),
        "record_type",
        F.when(revisit, page_of("refers_to")).alias("refers_to"),
    )
