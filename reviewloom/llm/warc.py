"""WARC archives: written as text parts by Spark, read back by verifying the chain of record boundaries.

A payload may contain the bytes that begin a record, so finding them proves nothing.
Tasks list every place with those bytes as a candidate, together with the offset where
its declared length says that the next record begins.  Pointer jumping from the start
of the file keeps the candidates on that chain and rejects the others.  Jumps are first
shortened within each block of a file, then over blocks, so that rounds grow with the
logarithm of a file's blocks.
"""

from __future__ import annotations

import base64

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.session import scratch_path, written

# Fixed values of the format.
MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + END
RECORD_ID = "urn:page:"


@F.pandas_udf(T.StringType())
def base32_of_hex(digest: pd.Series) -> pd.Series:
    return digest.map(lambda d: None if d is None else base64.b32encode(bytes.fromhex(d)).decode())


def write_warc(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """One record per row of ``pages`` (page_id, url, html), the html in UTF-8 as payload of an HTTP response.

    Of records with equal payloads of at least ``min_bytes`` the smallest page_id is the
    response; the others revisit it and carry no payload, only its digest and length.
    Null html is an empty payload; a null url is left out, control characters and spaces
    of others are percent-encoded.  Rows that share the smallest page_id and the payload
    are all responses; a null page_id counts as the largest and its record has no number.
    Payloads are compared by SHA-1 and length.  Other columns are ignored.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("_html")).withColumns({
        "_bytes": F.octet_length("_html").cast("bigint"), "_sha": F.sha1(F.col("_html").cast("binary"))})
    # Only digests are grouped; a payload stays where it was read.
    firsts = written(rows.filter(F.col("_bytes") >= min_bytes).groupBy("_sha", "_bytes").agg(
        F.min("page_id").alias("_first"), F.count("*").alias("_copies")).filter("_copies > 1").drop("_copies"), "payloads")
    placed = rows.join(firsts, ["_sha", "_bytes"], "left")
    revisits = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))

    def name(number: Column) -> Column:
        return F.concat(F.lit(f"<{RECORD_ID}"), F.coalesce(number.cast("string"), F.lit("")), F.lit(">"))

    uri = F.col("url")
    for place in [*range(33), 127]:
        uri = F.replace(uri, F.lit(chr(place)), F.lit(f"%{place:02X}"))
    body = F.concat(F.lit(HTTP_HEAD), F.when(revisits, "").otherwise(F.col("_html")))
    fields = [
        F.concat(F.lit("WARC-Type: "), F.when(revisits, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col("page_id"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), uri),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32_of_hex("_sha")),
        F.when(revisits, F.concat(F.lit("WARC-Refers-To: "), name(F.col("_first")))),
        F.when(revisits, F.lit(f"WARC-Profile: {PROFILE}")),
        F.when(revisits, F.concat(F.lit("X-Payload-Length: "), F.col("_bytes").cast("string"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string")),
    ]
    record = F.concat(F.lit(MAGIC), F.concat_ws("\r\n", *fields), F.lit(END), body)
    placed.select(record.alias("value")).write.option("lineSep", END).text(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Parts of the files between occurrences of the magic, numbered within each block that Spark reads."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("number"))


def _field(name: str) -> Column:
    return F.regexp_extract("_head", rf"(?i)(?:^|\r\n){name}: *([^\r\n]*)", 1)


def _candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every piece with its offset, where the next record would begin, its fields, and its payload if it is whole."""
    raw = F.col("value").cast("binary")
    read = _pieces(spark, path).withColumn("_head", F.substring_index("value", END, 1)).withColumns({
        "_bytes": F.octet_length("value").cast("bigint"), "_head_bytes": F.octet_length("_head").cast("bigint")})
    read = read.withColumn("_declared", F.when(F.col("_bytes") >= F.col("_head_bytes") + len(END),
                                               F.expr("try_cast(" + "regexp_extract(_head, '(?i)(?:^|\\\\r\\\\n)Content-Length: *([0-9]{1,18})', 1)" + " as bigint)")))
    size = F.col("_head_bytes") + F.col("_declared") + 2 * len(END)
    whole = size == F.col("_bytes")
    block = F.substring(raw, (F.col("_head_bytes") + len(END) + 1).cast("int"), F.col("_declared").cast("int"))
    listed = read.select(
        "file", "block", "number", "_bytes", size.alias("_size"), whole.alias("whole"),
        F.lower(_field("WARC-Type")).alias("record_type"), _field("WARC-Record-ID").alias("record_id"),
        _field("WARC-Target-URI").alias("uri"), _field("WARC-Refers-To").alias("refers"),
        _field("WARC-Payload-Digest").alias("stated_digest"), _field("X-Payload-Length").alias("stated_bytes"),
        F.when(whole, _payload(block)).alias("_payload"))
    listed = written(listed.select(*[c for c in listed.columns if c != "_payload"],
                                   F.octet_length("_payload").cast("bigint").alias("payload_bytes"), F.sha1("_payload").alias("_sha")), "pieces")
    # A block has the rows of one input split, a file one row per block.
    inside = Window.partitionBy("file", "block").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    length = F.col("_bytes") + len(MAGIC)
    blocks = listed.groupBy("file", "block").agg(F.sum(length).alias("_total"), F.count("*").alias("_count"))
    blocks = blocks.select("file", "block", F.coalesce(F.sum("_total").over(over), F.lit(0)).alias("_base"),
                           F.coalesce(F.sum("_count").over(over), F.lit(0)).alias("_earlier"))
    placed = listed.withColumn("_before", F.coalesce(F.sum(length).over(inside), F.lit(0))).withColumn(
        "_index", F.coalesce(F.count("*").over(inside), F.lit(0))).join(blocks, ["file", "block"])
    offset = F.col("_base") + F.col("_before") - len(MAGIC)
    return written(placed.withColumns({
        "offset": offset, "piece": F.col("_earlier") + F.col("_index"),
        "next": offset + len(MAGIC) + F.col("_size")}).drop("_before", "_base", "_earlier", "_index", "_size"), "candidates")


def _payload(block: Column) -> Column:
    """What follows the HTTP header of a record's block; the whole block without one."""
    head = F.substring_index(block.cast("string"), END, 1)
    ends = F.octet_length(head) + len(END)
    return F.when(F.octet_length(block) >= ends, F.substring(block, ends + 1, F.octet_length(block))).otherwise(block)


def _jumps(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted offsets, the candidate each one leads to (itself where it leaves the block), and where it leads."""
    group = group.sort_values("offset")
    offsets = group["offset"].to_numpy()
    leads = group["next"].fillna(-1).to_numpy().astype(np.int64)
    at = np.minimum(np.searchsorted(offsets, leads), len(offsets) - 1)
    stays = offsets[at] == leads
    return offsets, np.where(stays, at, np.arange(len(offsets))), np.where(stays | (leads > offsets[-1]), leads, -1)


def _exits(group: pd.DataFrame) -> pd.DataFrame:
    offsets, jump, leads = _jumps(group)
    for _ in range(max(1, len(offsets).bit_length())):
        jump = jump[jump]
    return pd.DataFrame({"file": group["file"].iat[0], "offset": offsets, "exit": leads[jump]})


def _reached(group: pd.DataFrame) -> pd.DataFrame:
    offsets, jump, _ = _jumps(group)
    reached = np.isin(offsets, group.loc[group["entry"], "offset"].to_numpy())
    for _ in range(max(1, len(offsets).bit_length())):
        reached[jump[reached]] = True
        jump = jump[jump]
    return pd.DataFrame({"file": group["file"].iat[0], "offset": offsets[reached]})


def _on_chain(candidates: DataFrame) -> DataFrame:
    """``file`` and ``offset`` of the candidates that the chain from the start of their file reaches."""
    links = candidates.filter("offset >= 0").select("file", "block", "offset", "next")
    per_block = links.groupBy("file", "block")
    exits = written(per_block.applyInPandas(_exits, "file string, offset long, exit long").filter("exit >= 0"), "exits")
    entries = links.filter("offset = 0").select("file", "offset")
    most = candidates.groupBy("file").agg(F.count_distinct("block").alias("n")).agg(F.max("n")).first()[0] or 1
    for _ in range(max(1, (most - 1).bit_length()) if most > 1 else 0):
        further = entries.join(exits, ["file", "offset"]).select("file", F.col("exit").alias("offset"))
        entries = written(entries.union(further).distinct(), "entries")
        onward = exits.select("file", F.col("offset").alias("exit"), F.col("exit").alias("_then"))
        exits = written(exits.join(onward, ["file", "exit"], "left").select(
            "file", "offset", F.coalesce("_then", "exit").alias("exit")), "exits")
    marked = links.join(entries.withColumn("entry", F.lit(True)), ["file", "offset"], "left").withColumn(
        "entry", F.coalesce("entry", F.lit(False)))
    return marked.groupBy("file", "block").applyInPandas(_reached, "file string, offset long")


def read_warc(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Records of all archives below ``path``: file, offset, record_type, record_id, uri, refers, stated_digest,
    stated_bytes, payload_bytes, payload_sha1 (hex) and, if asked for, payload.

    Files that do not begin with a record give no records.  A record cut off by the end
    of its file is listed without payload.  The figures of a payload are of what was read.
    """
    candidates = _candidates(spark, path)
    chain = candidates.join(written(_on_chain(candidates), "chain"), ["file", "offset"])
    columns = ["file", "offset", "record_type", "record_id", "uri", "refers", "stated_digest", "stated_bytes"]
    split = chain.filter(F.lit(with_payload) | ~F.coalesce("whole", F.lit(False)))
    simple = chain.filter(F.coalesce("whole", F.lit(False))).select(*columns, "payload_bytes", F.col("_sha").alias("payload_sha1"))
    if not with_payload and split.isEmpty():
        return simple

    # Records in several pieces: their parts are read again and joined by the magic between them.
    starts = candidates.select("file", F.col("offset").alias("next"), F.col("piece").alias("_until"))
    ends = candidates.groupBy("file").agg((F.max("piece") + 1).alias("_last"))
    spans = split.join(starts, ["file", "next"], "left").join(ends, "file").select(
        *columns, "next", F.explode(F.sequence("piece", F.coalesce("_until", "_last") - 1)).alias("piece"))
    wanted = spans.join(candidates.select("file", "piece", "block", "number"), ["file", "piece"])
    texts = _pieces(spark, path).select("file", "block", "number", "value").join(
        wanted.select(*columns, "next", "block", "number", "piece"), ["file", "block", "number"])
    whole = texts.groupBy(*columns, "next").agg(F.sort_array(F.collect_list(F.struct("piece", "value"))).alias("_parts"))
    value = F.array_join(F.transform("_parts", lambda p: p["value"]), MAGIC)
    whole = whole.withColumn("_value", value).withColumn("_head", F.substring_index("_value", END, 1))
    raw = F.col("_value").cast("binary")
    declared = F.col("next") - F.col("offset") - len(MAGIC) - F.octet_length("_head") - 2 * len(END)
    block = F.substring(raw, F.octet_length("_head") + len(END) + 1, declared.cast("int"))
    complete = F.octet_length(raw) >= F.col("next") - F.col("offset") - len(MAGIC)
    whole = whole.withColumn("payload", F.when(complete, _payload(block)))
    joined = whole.select(*columns, F.octet_length("payload").cast("bigint").alias("payload_bytes"),
                          F.sha1("payload").alias("payload_sha1"), *(["payload"] if with_payload else []))
    return joined if with_payload else simple.unionByName(joined)


def archived(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read them back.

    Per record ``page_id``, ``payload_bytes``, ``payload_digest`` (base32 SHA-1, of the
    full payload also for revisits), ``record_type`` and ``refers_to``.
    """
    path = scratch_path(pages.sparkSession, "warc")
    write_warc(pages, path, min_bytes)
    read = read_warc(pages.sparkSession, path)

    def number(column: str) -> Column:
        return F.expr(f"try_cast(regexp_extract({column}, '{RECORD_ID}(-?[0-9]+)', 1) as bigint)")

    revisit = F.col("record_type") == "revisit"
    return read.select(
        number("record_id").alias("page_id"),
        F.when(revisit, F.expr("try_cast(stated_bytes as bigint)")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.regexp_replace("stated_digest", "^sha1:", "")).otherwise(base32_of_hex("payload_sha1")).alias("payload_digest"),
        "record_type", number("refers").alias("refers_to"))
