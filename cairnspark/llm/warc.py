"""WARC archives: writing records with revisits, and reading them back by boundary chains.

Writing uses Spark's text writer with the record terminator as separator, so
archives go through the usual commit protocol to any store that Spark writes.
Of records with equal payloads of at least ``min_revisit`` bytes, the one with
the smallest page id is a response and the others revisit it.

Reading splits files at the version line, wherever it stands, so a payload
that holds one yields false starts.  Each task emits, for every candidate
start in its split, the offset of the record's successor (from the header's
Content-Length) and where the chain leaves the split; pointer jumping from
offset 0 of each file over those exits finds each split's true entry, and only
records on the chain are kept.  Records that contain the magic are put
together again from their pieces.

Edge cases: a null payload is empty; a null URL is written empty, line breaks
in it become spaces; an empty table writes no record and reads none; very long
payloads and header fields are one record; extra columns are ignored; a row
without a page id has a record of that name and is read back without one;
repeated page ids keep a record each, and a revisit finds its response by page
id and payload digest together.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairnspark.llm.shared import Scratch, cut, drop, new_path, within

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
MIN_REVISIT = 100
BROADCAST_BYTES = 32 << 20
DATE = "2026-01-01T00:00:00Z"


def write(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT, broadcast_bytes: int = BROADCAST_BYTES) -> None:
    """Write ``pages(page_id, url, html)`` as WARC files under ``path``."""
    d = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    d = d.withColumn("size", F.octet_length("html").cast("long")).withColumn("digest", F.sha2("html", 256))
    narrow = d.where(F.col("size") >= min_revisit).select("digest", "page_id")
    firsts = cut(narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("c")).where("c > 1").select(F.col("digest").alias("dg"), "first"), "digests")
    if within(firsts, "dg", broadcast_bytes):
        d = d.join(F.broadcast(firsts), (F.col("digest") == F.col("dg")) & (F.col("size") >= min_revisit), "left")
        first = F.when(F.col("first") != F.col("page_id"), F.col("first"))
    else:  # payloads move only by page id, which no key crowds
        again = narrow.join(firsts, (F.col("digest") == F.col("dg")) & (F.col("page_id") != F.col("first"))).select(F.col("page_id").alias("pid"), F.col("first")).distinct()
        d = d.join(again, F.col("page_id") == F.col("pid"), "left")
        first = F.when(F.col("size") >= min_revisit, F.col("first"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(END))
    block = F.when(first.isNull(), F.concat(http, "html")).otherwise(http)
    head = F.concat_ws(
        "\r\n",
        F.lit(MAGIC.strip()),
        F.when(first.isNull(), "WARC-Type: response").otherwise("WARC-Type: revisit"),
        F.concat(F.lit("WARC-Record-ID: "), urn(F.col("page_id"))),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", "[\\r\\n]+", " ")),
        F.lit(f"WARC-Date: {DATE}"),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), "digest"),
        F.when(first.isNotNull(), F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.when(first.isNotNull(), F.concat(F.lit("WARC-Refers-To: "), urn(first))),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    d.select(F.concat(head, F.lit(END), block)).write.option("lineSep", END).text(path)
    drop(firsts)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """(path, blk, value): what stands between version lines, in file order within each split (path, blk)."""
    raw = spark.read.schema("value string").option("lineSep", MAGIC).text(path)
    return raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("blk"), F.col("value").cast("binary").alias("value"))


def parse(value: bytes) -> dict | None:
    """A record after its version line: header fields, header length and Content-Length; None if it is no record start."""
    at = value.find(b"\r\n\r\n")
    if at < 0:
        return None
    fields = {}
    for line in value[:at].split(b"\r\n"):
        k, colon, v = line.partition(b":")
        if not colon:
            return None
        fields[k.strip().lower()] = v.strip()
    length = fields.get(b"content-length", b"")
    if not length.isdigit() or b"warc-type" not in fields:
        return None
    return {"fields": fields, "head": at + 4, "length": int(length)}


def _page(urn: bytes | None) -> int | None:
    tail = (urn or b"").strip(b"<>").rpartition(b":")[2]
    return int(tail) if tail.lstrip(b"-").isdigit() else None


def content(value: bytes, got: dict) -> tuple[int | None, str, int | None, int, str]:
    """Page id, type, page referred to, payload size and SHA-256 of a complete record; a revisit's SHA-256 is the one it names."""
    block = value[got["head"] : got["head"] + got["length"]]
    at = block.find(b"\r\n\r\n")
    payload = block[at + 4 :] if at >= 0 else b""
    f = got["fields"]
    kind = f[b"warc-type"].decode()
    digest = hashlib.sha256(payload).hexdigest()
    if kind == "revisit":
        digest = f.get(b"warc-payload-digest", b"").rpartition(b":")[2].decode()
    return _page(f.get(b"warc-record-id")), kind, _page(f.get(b"warc-refers-to")), len(payload), digest


CANDIDATE = (
    "path string, blk long, rel long, size long, start boolean, succ long, exit long, whole boolean, "
    "page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string"
)
_FIELDS = pa.schema(
    [("path", pa.string()), ("blk", pa.int64()), ("rel", pa.int64()), ("size", pa.int64()), ("start", pa.bool_()), ("succ", pa.int64()), ("exit", pa.int64()), ("whole", pa.bool_()),
     ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
)


def _candidates(batches):
    """Candidates of each split, with offsets from the end of the split's first version line."""
    split, at, held = None, 0, []

    def flush():
        if not held:
            return
        exits = {r[2]: r[5] for r in held if r[4]}
        for rel in sorted(exits, reverse=True):  # successors lie ahead, so theirs are final
            exits[rel] = exits.get(exits[rel], exits[rel])
        cols = list(zip(*[(*r[:6], exits.get(r[2]), *r[6:]) for r in held], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _FIELDS, strict=True)], schema=_FIELDS)
        held.clear()

    n = len(MAGIC)
    for batch in batches:
        for path, blk, value in zip(batch.column("path").to_pylist(), batch.column("blk").to_pylist(), batch.column("value"), strict=True):
            if (path, blk) != split:
                yield from flush()
                split, at = (path, blk), 0
            v = value.as_py()
            # the very first piece of a file precedes its first version line
            got = None if blk == 0 and at == 0 else parse(v)
            rel, size = at - n, len(v) + n
            row = [path, blk, rel, size, got is not None, None, False, None, None, None, None, None]
            if got:
                row[5] = rel + n + got["head"] + got["length"] + len(END)
                if row[5] == rel + size:
                    row[6] = True
                    row[7:] = content(v, got)
            held.append(tuple(row))
            at += size
    yield from flush()


def _chain(pdf):
    """Of a split's candidates, those on the chain from its entry."""
    succ = dict(zip(pdf["off"].tolist(), pdf["succ"].tolist(), strict=True))
    x, good = int(pdf["entry"].iloc[0]), set()
    while x in succ and x not in good:
        good.add(x)
        x = succ[x]
    return pdf[pdf["off"].isin(good)][["path", "off"]]


def read(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record_type, refers_to, payload_bytes, payload_digest) of the records on each file's chain."""
    work = Scratch()
    cand = work.cut(pieces(spark, path).mapInArrow(_candidates, CANDIDATE), "candidates")
    splits = cand.groupBy("path", "blk").agg(F.sum("size").alias("bytes"))
    before = Window.partitionBy("path").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    base = work.cut(splits.select("path", "blk", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base")), "splits")
    # offsets of version lines: the first piece of a file precedes one and has offset -len(MAGIC)
    c = cand.join(base, ["path", "blk"]).select("*", (F.col("base") + F.col("rel")).alias("off"), (F.col("base") + F.col("exit")).alias("out"), (F.col("base") + F.col("succ")).alias("next"))
    c = work.cut(c, "offsets")
    starts = c.where("start")
    most = base.groupBy("path").agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).first().n or 0
    reach = starts.select("path").distinct().withColumn("off", F.lit(0).cast("long"))
    jump = starts.select("path", "off", F.col("out").alias("to"))
    for _ in range(int(np.ceil(np.log2(max(1, most))))):
        reach = work.cut(reach.union(reach.join(jump, ["path", "off"]).select("path", F.col("to").alias("off"))).distinct(), "reach")
        jump = work.cut(jump.join(jump.select("path", F.col("off").alias("to"), F.col("to").alias("far")), ["path", "to"], "left").select("path", "off", F.coalesce("far", "to").alias("to")), "jump")
    entry = starts.select("path", "blk", "off").join(reach, ["path", "off"]).groupBy("path", "blk").agg(F.min("off").alias("entry"))
    true = starts.select("path", "blk", "off", F.col("next").alias("succ")).join(entry, ["path", "blk"]).groupBy("path", "blk").applyInPandas(_chain, "path string, off long")
    records = work.cut(starts.join(true, ["path", "off"]), "records")
    fields = ["page_id", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    out = records.where("whole").select(*fields)
    torn = records.where("not whole").select("path", F.col("off").alias("rec"), "next")
    if torn.limit(1).count():
        out = out.union(_mend(spark, path, c, torn, work).select(*fields))
    out = cut(out, "read")
    work.clear()
    return out


def _mend(spark: SparkSession, path: str, c: DataFrame, torn: DataFrame, work: Scratch) -> DataFrame:
    """Records whose block holds the magic, from the pieces between their start and their successor."""
    marks = c.select("path", "blk", "rel", "off").join(torn.select("path", F.col("rec").alias("off"), "rec", "next"), ["path", "off"], "left")
    order = Window.partitionBy("path").orderBy("off").rowsBetween(Window.unboundedPreceding, 0)
    owned = marks.select("path", "blk", "rel", "off", F.last("rec", True).over(order).alias("rec"), F.last("next", True).over(order).alias("next"))
    wanted = work.cut(owned.where("rec is not null and off < next").select("path", "blk", "rel", "off", "rec"), "wanted")
    few = within(wanted, "path", BROADCAST_BYTES)
    parts = pieces(spark, path).mapInArrow(_placed, "path string, blk long, rel long, value binary")
    parts = parts.join(F.broadcast(wanted) if few else wanted, ["path", "blk", "rel"])
    whole = parts.groupBy("path", "rec").agg(F.array_sort(F.collect_list(F.struct("off", "value"))).alias("v")).select(F.col("v.value").alias("v"))
    return whole.mapInArrow(_joined, "page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string")


def _placed(batches):
    split, at, n = None, 0, len(MAGIC)
    for batch in batches:
        rel = []
        for path, blk, value in zip(batch.column("path").to_pylist(), batch.column("blk").to_pylist(), batch.column("value"), strict=True):
            if (path, blk) != split:
                split, at = (path, blk), 0
            rel.append(at - n)
            at += len(value.as_py()) + n
        yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("blk"), pa.array(rel, pa.int64()), batch.column("value")], names=["path", "blk", "rel", "value"])


def _joined(batches):
    magic = MAGIC.encode()
    for batch in batches:
        for v in batch.column("v"):
            value = magic.join(v.as_py())
            got = parse(value)
            if got:
                cols = [[x] for x in content(value, got)]
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(cols, list(_FIELDS)[8:], strict=True)], names=_FIELDS.names[8:])


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    write(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), path)
    got = read(spark, path)
    responses = got.where("record_type = 'response'")
    again = got.where("record_type = 'revisit'").select("page_id", "refers_to", F.col("payload_digest").alias("digest"))
    first = responses.select(F.col("page_id").alias("t"), F.col("payload_bytes").alias("tb"), F.col("payload_digest").alias("td")).distinct()
    revisits = again.join(first, F.col("refers_to").eqNullSafe(F.col("t")) & (F.col("digest") == F.col("td"))).select("page_id", "tb", "td", F.lit("revisit"), "refers_to")
    return responses.select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to")).union(revisits)


OP7_SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= {MIN_REVISIT} THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to FROM f
"""
