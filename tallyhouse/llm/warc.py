"""WARC archives: writing records with revisits, and reading by boundary-chain verification.

Writing. A record is a row of text that Spark writes with the record separator as line separator,
so archives go to any file system that Spark knows. Of records with equal payloads of some size
one is a response and the others revisit it, without a payload.

Reading. A file is read in splits, cut at each magic ``WARC/1.x``, also where the magic lies inside
a payload. A task turns each piece into a candidate with the offset of its successor, from the
header's Content-Length, and follows candidates to where they leave the split. These exits are few,
and pointer jumping over them from the start of each file finds the one entry of each split that
the file's chain of records passes. A second scan follows the chain from that entry and returns its
records only; pieces that no chain reaches are parts of a payload. A record that runs on in the
next split is put together from its parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha1

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import cut_lineage, small_batches
from tallyhouse.session import fits_broadcast

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
REVISIT_BYTES = 1000
_LENGTH = re.compile(rb"(?:^|\r\n)content-length:[ \t]*([0-9]{1,18})[ \t]*(?=\r\n|$)", re.IGNORECASE)


def record(kind: Column, page: Column, url: Column, payload: Column, digest: Column, refers_to: Column) -> Column:
    """The text of a record, without the separator that follows it."""

    def uri(number: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), number.cast("string"), F.lit(">"))

    body = F.when(kind == "revisit", F.lit("")).otherwise(payload)
    clean = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]+", " ")
    return F.concat(
        F.lit(MAGIC + "WARC-Type: "),
        kind,
        F.lit("\r\nWARC-Record-ID: "),
        F.coalesce(uri(page), F.lit("<urn:page:none>")),
        F.lit("\r\nWARC-Target-URI: "),
        clean,
        F.lit("\r\nWARC-Payload-Digest: sha1:"),
        digest,
        F.lit("\r\nX-Payload-Length: "),
        F.octet_length(payload).cast("string"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Refers-To: "), uri(refers_to)), F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit(END),
        body,
    )


def write_archives(pages: DataFrame, folder: str, least: int = REVISIT_BYTES) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) into archives in ``folder``.

    Null html is an empty payload. Of rows with equal payloads of ``least`` bytes or more, the one
    with the largest page_id is the response and the others revisit it; all rows with that
    page_id are responses, and so is any row without a page_id. Digests are grouped, not payloads.
    """
    payload = F.coalesce("html", F.lit(""))
    digested = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1(F.encode("payload", "UTF-8")))
    large = F.octet_length("payload") >= least
    shared = (
        digested.where(large)
        .groupBy("digest")
        .agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first is not null")
        .select("digest", "first")
    )
    shared = cut_lineage(shared, "repeated-payloads")
    if fits_broadcast(shared):
        shared = F.broadcast(shared)
    joined = digested.join(shared, "digest", "left")
    kind = F.when(large & (F.col("first") != F.col("page_id")), F.lit("revisit")).otherwise(F.lit("response"))
    lines = joined.withColumn("kind", kind).select(
        record(
            F.col("kind"),
            F.col("page_id"),
            F.col("url"),
            F.col("payload"),
            F.col("digest"),
            F.when(F.col("kind") == "revisit", F.col("first")),
        ).alias("value")
    )
    lines.write.option("lineSep", END).text(folder)


def _scan(spark: SparkSession, folder: str) -> DataFrame:
    """The pieces of the archives between magics, in order within each split."""
    text = spark.read.option("lineSep", MAGIC).text(folder)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("piece")
    )


def _record_length(piece: bytes) -> tuple[int, int] | None:
    """Bytes from the magic to the end of the record, and to its content; None for no record."""
    end = piece.find(b"\r\n\r\n")
    if end < 0:
        return None
    found = _LENGTH.search(piece, 0, end)
    if not found:
        return None
    content = len(MAGIC) + end + 4
    return content + int(found[1]) + len(END), content


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split its bytes, and per candidate its place and where its chain leaves the split (or
    breaks off), both counted from the split's first byte. The first piece of a file is what
    stands before its first magic."""
    now: tuple[str, int] | None = None
    total, following = 0, {}

    def closed() -> pa.RecordBatch:
        exits: dict[int, int] = {}
        for at in sorted(following, reverse=True):
            exits[at] = exits.get(following[at], following[at])
        columns = ([now[0]], [now[1]], [total], [list(exits)], [list(exits.values())])
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "split", "bytes", "at", "exit"]
        )

    for batch in batches:
        for file, split, piece in zip(*[batch.column(i).to_pylist() for i in range(2)], batch.column(2), strict=True):
            content = piece.as_py()
            if (file, split) != now:
                if now is not None:
                    yield closed()
                now, total, following = (file, split), 0, {}
                if split == 0:
                    total += len(content)
                    continue
            found = _record_length(content)
            if found is not None:
                following[total] = total + found[0]
            total += len(MAGIC) + len(content)
    if now is not None:
        yield closed()


def chains(spark: SparkSession, folder: str) -> DataFrame:
    """Per split (file, split): the offset of its first byte (base), the offset where its file's
    chain of records enters it (entry, null if it does not), and where the record that is open at
    its first byte ends (open_until)."""
    with small_batches(spark, 500):
        found = cut_lineage(
            _scan(spark, folder).mapInArrow(_candidates, "file string, split long, bytes long, at array<long>, exit array<long>"), "candidates"
        )
    in_file = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = found.select("file", "split", "bytes", F.coalesce(F.sum("bytes").over(in_file), F.lit(0)).alias("base"))
    splits = cut_lineage(splits, "splits")
    steps = (
        found.select("file", "split", F.explode(F.arrays_zip("at", "exit")).alias("c"))
        .join(splits.drop("bytes"), ["file", "split"])
        .select("file", (F.col("base") + F.col("c.at")).alias("at"), (F.col("base") + F.col("c.exit")).alias("exit"))
    )
    steps = cut_lineage(steps, "steps")
    # A chain can enter a split at an exit of another one, or begin there.
    first = cut_lineage(steps.groupBy("file").agg(F.min("at").alias("at")), "reached")
    nodes = steps.select("file", F.col("exit").alias("at")).union(first).distinct()
    jumps = cut_lineage(steps.join(nodes, ["file", "at"]), "jumps")
    reached = first
    longest = splits.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    for _ in range(longest.bit_length()):
        ahead = reached.join(jumps, ["file", "at"]).select("file", F.col("exit").alias("at"))
        reached = cut_lineage(reached.union(ahead).distinct(), "reached")
        onward = jumps.select("file", F.col("at").alias("exit"), F.col("exit").alias("onward"))
        jumps = cut_lineage(jumps.join(onward, ["file", "exit"]).select("file", "at", F.col("onward").alias("exit")), "jumps")
    inside = (F.col("at") >= F.col("base")) & (F.col("at") < F.col("base") + F.col("bytes"))
    return cut_lineage(
        splits.join(reached, "file", "left")
        .groupBy("file", "split", "base")
        .agg(F.min(F.when(inside, F.col("at"))).alias("entry"), F.min(F.when(F.col("at") >= F.col("base"), F.col("at"))).alias("open_until")),
        "chains",
    )


_PART = "file string, ends long, at long, head binary, length long, body binary, complete boolean"


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of the records on the chain. A record is known by the offset of its end; a piece before
    the split's entry, or one that the chain jumps over, goes on with the record that is open."""
    now, total, entry, until = None, 0, None, None
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.bool_())
    for batch in batches:
        out: list[tuple] = []
        facts = [batch.column(i).to_pylist() for i in (0, 1, 3, 4, 5)]
        for file, split, base, enters, opened, piece in zip(*facts, batch.column(2), strict=True):
            content = piece.as_py()
            if (file, split) != now:
                now, total, entry, until = (file, split), base, enters, opened
                if split == 0:
                    total += len(content)
                    continue
            if total == entry:
                found = _record_length(content)
                entry = until = total + found[0] if found else None
                if found:
                    head = found[1] - len(MAGIC)
                    length = found[0] - found[1] - len(END)
                    whole = len(content) - head >= length
                    body = content[head : head + length] if whole else content[head:]
                    out.append((file, until, total, content[: head - 4], length, body, whole))
            elif until is not None and total < until:
                out.append((file, until, total, None, None, MAGIC.encode() + content, False))
            total += len(MAGIC) + len(content)
        if out:
            columns = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["file", "ends", "at", "head", "length", "body", "complete"],
            )


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all archives in ``folder``: file, offset, head (its lines as text), payload.

    Records are those that the chain from the start of their file reaches; it begins at the first
    magic with a readable header and ends where no record follows. An empty folder or file gives no rows.
    """
    known = chains(spark, folder)
    pieces = _scan(spark, folder)
    facts = ["base", "entry", "open_until"]
    if fits_broadcast(known):
        met = pieces.join(F.broadcast(known.withColumn("_known", F.lit(True))), ["file", "split"], "left")
    else:
        ordered = pieces.withColumn("_n", F.monotonically_increasing_id())
        met = ordered.join(known.withColumn("_known", F.lit(True)).hint("merge"), ["file", "split"], "left")
        met = met.sortWithinPartitions("file", "split", "_n")
    base = F.when(F.col("_known"), F.col("base")).otherwise(F.raise_error(F.lit("the archives were split another way; read them again")).cast("long"))
    met = met.select("file", "split", "piece", base.alias("base"), *facts[1:])
    parts = met.mapInArrow(_follow, _PART)
    single = parts.where("complete and head is not null").select("file", F.col("at").alias("offset"), "head", F.col("body").alias("payload"))
    some = parts.where("not complete")
    several = (
        some.groupBy("file", "ends")
        .agg(
            F.min(F.when(F.col("head").isNotNull(), F.col("at"))).alias("offset"),
            F.max("head").alias("head"),
            F.max("length").alias("length"),
            F.sort_array(F.collect_list(F.struct("at", "body"))).alias("parts"),
        )
        .where("head is not null")
    )
    joined = F.aggregate("parts", F.lit("").cast("binary"), lambda a, p: F.concat(a, p["body"]))
    several = several.select("file", "offset", "head", F.substring(joined, F.lit(1), F.col("length").cast("int")).alias("payload"))
    return single.unionByName(several).withColumn("head", F.decode("head", "UTF-8"))


def field(name: str) -> Column:
    """A header field of ``head``; null where it is missing."""
    value = F.regexp_extract("head", rf"(?im)^{re.escape(name)}:[ \t]*([^\r\n]*)", 1)
    return F.when(value != "", value)


def round_trip(pages: DataFrame, folder: str) -> DataFrame:
    """Per page what its record says: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Size and digest of a response are those of the payload read back, of a revisit those it
    declares.
    """
    write_archives(pages, folder)
    records = read_archives(pages.sparkSession, folder)
    number = r"<urn:page:(-?[0-9]+)>"
    kind = field("WARC-Type")

    def page(name: str) -> Column:
        return F.regexp_extract(F.coalesce(field(name), F.lit("")), number, 1)

    own, other = page("WARC-Record-ID"), page("WARC-Refers-To")
    here = kind == "response"
    return records.select(
        F.when(own != "", own).cast("long").alias("page_id"),
        F.when(here, F.octet_length("payload")).otherwise(field("X-Payload-Length")).cast("long").alias("payload_bytes"),
        F.when(here, F.sha1("payload")).otherwise(F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "")).alias("payload_digest"),
        kind.alias("record_type"),
        F.when(other != "", other).cast("long").alias("refers_to"),
    )
