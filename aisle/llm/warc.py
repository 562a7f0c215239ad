"""WARC archives: writing, and reading by boundary-chain verification.

Writing: of the rows with equal payloads the one with the smallest id is a
``response`` record, the others are ``revisit`` records without a payload
that name it; payloads below ``min_bytes`` are all responses.  Only payloads
with copies are shuffled; a bitmap of their digests tells them.  The text
writer joins records with the format's own terminator, so each task writes
one archive and nothing passes the driver.

Reading: the text reader cuts archives at the magic ``WARC/1.``, split by
split on all executors, and every cut is a candidate record.  A candidate
names its successor by its Content-Length.  The task contracts the chains
inside its split, so each candidate points to the first position behind the
split; the lengths of the splits give file offsets.  Pointer jumping from the
start of each file (jumps double, so the logarithm of the number of splits)
gives the first true record of each split, and a second scan follows the
chain from there.  What the chain does not reach is magic inside a payload
and goes back into the payload that holds it, also across splits.

Edge cases: a null payload is empty; a null or empty url gives a record
without a target URI; in a url, control characters are percent-encoded, and
so is the W of a magic; a null id gives an empty id that reads back as null,
and it sorts before all others; rows that repeat the smallest id of a payload
are all responses; a header may have any length; a last record that the file
cuts off, also in its header, is returned with ``truncated``; what follows a
record and is none is returned as a payload without fields, not ``intact``; an
empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored

MAGIC = "WARC/1."
TERMINATOR = "\r\n\r\n"
# Fixed value: the alphabet of base32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ID_PREFIX = "urn:x-row:"
LENGTH_FIELD = "WARC-X-Payload-Length"
HEADER_END = b"\r\n\r\n"
# Bits that tell the payloads with copies from the others; at more of them
# than a tenth of this, more single payloads are shuffled with the copies.
MARK_BITS = 1 << 26
CONTENT_LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*(\d+)[ \t]*\r\n", re.I)


# -- writing ---------------------------------------------------------------

def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: eight groups of twenty bits, each four
    characters of five bits."""
    hexed = F.sha1(payload)
    chars = []
    for group in range(8):
        value = F.conv(F.substring(hexed, 5 * group + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            place = F.shiftright(value, shift).bitwiseAND(F.lit(31)) + 1
            chars.append(F.substring(F.lit(BASE32), place, F.lit(1)))
    return F.concat(*chars)


def classify(pages: DataFrame, row_id: str, payload: str, url: str, min_bytes: int = 0) -> DataFrame:
    """id, url, payload, payload_bytes, digest, record_type, refers_to."""
    rows = (pages.select(F.col(row_id).cast("long").alias("id"), F.col(url).alias("url"),
                         F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary")).alias("payload"))
            .withColumn("payload_bytes", F.octet_length("payload").cast("long"))
            .withColumn("digest", sha1_base32(F.col("payload"))))
    # a hot payload is summed up before the shuffle, and the join below can be
    # split by the adaptive planner, as its right side has one row per digest
    first = stored(rows.where(F.col("payload_bytes") >= min_bytes).groupBy("digest")
                   .agg(F.min(F.struct(F.col("id").isNotNull(), F.col("id"))).alias("least"), F.count("*").alias("copies"))
                   .where("copies > 1").select("digest", "least"), "copied")
    named = ["id", "url", "payload", "payload_bytes", "digest"]
    marked = _mark(rows, first, "digest")
    alone = marked.where(~F.col("marked")).select(*named, F.lit("response").alias("record_type"),
                                                  F.lit(None).cast("long").alias("refers_to"))
    again = F.col("least").isNotNull() & ~F.col("id").eqNullSafe(F.col("least.id"))
    return alone.union(marked.where("marked").join(first, "digest", "left").select(
        *named, F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("least.id")).alias("refers_to")))


def _mark(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Adds ``marked``: false only where ``keys`` does not hold the row's key.
    The keys are hashed into bitmaps of at most ``MARK_BITS`` bits together,
    which every task gets, so that rows with a key of their own are told
    without a shuffle of what they carry."""
    place = F.pmod(F.xxhash64(key), F.lit(MARK_BITS)) + 1
    bitmaps = (keys.select(F.bitmap_bucket_number(place).alias("_bucket"), F.bitmap_bit_position(place).alias("_bit"))
               .groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bitmap")))
    byte = F.substring("_bitmap", F.shiftright("_bit", 3).cast("int") + 1, F.lit(1))
    held = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), F.col("_bit") % 8) == 1
    return (rows.withColumns({"_bucket": F.bitmap_bucket_number(place), "_bit": F.bitmap_bit_position(place)})
            .join(F.broadcast(bitmaps), "_bucket", "left").withColumn("marked", F.coalesce(held, F.lit(False)))
            .drop("_bucket", "_bit", "_bitmap"))


def _safe_url(url: Column) -> Column:
    for code in [*range(0x20), 0x7F]:
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.replace(url, F.lit(MAGIC), F.lit("%57" + MAGIC[1:]))


def write_archives(records: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", compression: str = "gzip") -> None:
    """Write what ``classify`` returns, one archive per partition.  With
    compression ``none`` readers can split an archive."""
    id_text = lambda c: F.concat(F.lit(f"<{ID_PREFIX}"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">\r\n"))
    response = F.col("record_type") == "response"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(TERMINATOR))
    block = F.when(response, F.concat(http, F.col("payload").cast("string"))).otherwise("")
    url = F.coalesce(F.col("url"), F.lit(""))
    record = F.concat(
        F.lit(f"{MAGIC}0\r\nWARC-Type: "), F.col("record_type"),
        F.lit("\r\nWARC-Record-ID: "), id_text(F.col("id")),
        F.lit(f"WARC-Date: {date}\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit(f"\r\n{LENGTH_FIELD}: "), F.col("payload_bytes").cast("string"), F.lit("\r\n"),
        F.when(url == "", "").otherwise(F.concat(F.lit("WARC-Target-URI: "), _safe_url(url), F.lit("\r\n"))),
        F.when(response, "Content-Type: application/http; msgtype=response\r\n").otherwise(F.concat(
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
            id_text(F.col("refers_to")))),
        F.lit("Content-Length: "), F.octet_length("_block").cast("string"), F.lit(TERMINATOR), F.col("_block"))
    (records.withColumn("_block", block).select(record.alias("value"))
     .write.option("lineSep", TERMINATOR).option("compression", compression).text(path))


# -- reading ---------------------------------------------------------------

def _cuts(spark: SparkSession, path: str) -> DataFrame:
    """What stands between the magics of each archive, split by split."""
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.col("value").cast("binary").alias("cut")))


def head(data: bytes) -> tuple[int, int] | None:
    """Length of the header behind the magic, and Content-Length; None for
    what is no header, and (-1, 0) for one that goes on behind ``data``."""
    if not re.match(rb"\d\r\n", data):
        return None
    end = data.find(HEADER_END)
    if end < 0:
        return -1, 0
    found = CONTENT_LENGTH.search(data, 0, end + 2)
    return (end + 4, int(found[1])) if found else None


def _by_split(batches: Iterator[pa.RecordBatch], columns: int = 3):
    """(file, block, further columns) and an iterator of the cuts, for each
    split that a task reads."""
    def rows():
        for batch in batches:
            # the cuts leave Arrow one by one, so a batch is held only once
            for i in range(batch.num_rows):
                yield [batch.column(k)[i].as_py() for k in range(columns)]
    row = None
    source = rows()
    row = next(source, None)
    while row is not None:
        key = (row[0], row[1], *row[3:])

        def cuts():
            nonlocal row
            while row is not None and (row[0], row[1], *row[3:]) == key:
                yield row[2]
                row = next(source, None)
        mine = cuts()
        yield key, mine
        for _ in mine:
            pass


def candidate_chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each split, one row with its length (at = -1), and one for each
    candidate: its position, the last candidate of its chain inside the split
    and the position behind the split that follows; all from the start of the
    split."""
    size = len(MAGIC)
    for (file, block), cuts in _by_split(batches):
        # headers that have not ended, as magic may be inside a header: those
        # without a Content-Length so far, and those with one.  Neither that
        # field nor the end can hold magic, so each is looked for in one cut
        here, follows, bare, sized = 0, {}, [], []
        for cut in cuts:
            if re.match(rb"\d\r\n", cut):
                bare.append(here)
            if bare or sized:
                end = cut.find(HEADER_END)
                found = CONTENT_LENGTH.search(cut, 0, end + 2 if end >= 0 else len(cut)) if bare else None
                if found:
                    sized += [(at, int(found[1])) for at in bare]
                    bare = []
                if end >= 0:
                    for at, content in sized:
                        follows[at] = here + end + len(HEADER_END) + content + len(TERMINATOR) + size
                    bare, sized = [], []
            here += len(cut) + size
        last = {}
        for at in sorted(follows, reverse=True):
            succ = follows[at]
            last[at] = last.get(succ, at)
            follows[at] = follows.get(succ, succ)
        at = [-1, *follows]
        yield pa.RecordBatch.from_arrays(
            [pa.array([file] * len(at)), pa.array([block] * len(at), pa.int64()), pa.array(at, pa.int64()),
             pa.array([-1, *(last[p] for p in follows)], pa.int64()), pa.array([here, *follows.values()], pa.int64())],
            names=["file", "block", "at", "last", "next"])


def true_starts(chains: DataFrame) -> DataFrame:
    """(file, block, base, first, owner) for each split: where it starts, its
    first true record, and the record that is open at its start.  Pointer
    jumping from the start of each file finds the true records."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = stored(chains.where("at < 0").select(
        "file", "block", F.coalesce(F.sum("next").over(before), F.lit(0)).alias("base")), "splits")
    moved = chains.where("at >= 0").join(splits, ["file", "block"]).select(
        "file", "block", *((F.col(c) + F.col("base")).alias(c) for c in ("at", "last", "next")))
    links = stored(moved, "links")
    jumps = links.select("file", "at", "next")
    reached = stored(links.where(F.col("at") == len(MAGIC)).select("file", "at"), "reached")
    while True:
        new = stored(reached.join(jumps, ["file", "at"]).select("file", F.col("next").alias("at"))
                     .join(jumps.select("file", "at"), ["file", "at"], "left_semi")
                     .join(reached, ["file", "at"], "left_anti"), "reached")
        if new.isEmpty():
            break
        reached = reached.union(new)
        target = jumps.select("file", F.col("at").alias("next"), F.col("next").alias("onward"))
        jumps = stored(jumps.join(target, ["file", "next"], "left")
                       .select("file", "at", F.coalesce("onward", "next").alias("next")), "jumps")
    firsts = links.join(reached, ["file", "at"], "left_semi").select("file", "block", F.col("at").alias("first"), "last")
    return stored(splits.join(firsts, ["file", "block"], "left")
                  .select("file", "block", "base", "first", F.max("last").over(before).alias("owner")), "starts")


def _records(whole: bool):
    """Follow the chain of each split from its first true record.  ``whole``:
    the records that end in their split; otherwise, of the others, what this
    split holds, under the position of the record."""
    size = len(MAGIC)
    magic = MAGIC.encode()

    def row(file, at, piece, data):
        return pa.RecordBatch.from_arrays(
            [pa.array([file]), pa.array([at], pa.int64()), pa.array([piece], pa.int64()), pa.array([data], pa.binary())],
            names=["file", "at", "piece", "data"])

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, _, base, first, owner), cuts in _by_split(batches, 6):
            here, start, need, held, lead, unread = base, None, None, [], [], False
            for cut in cuts:
                if here == first if start is None else need is not None and here == start + need + size:
                    if start is not None and whole:
                        yield row(file, start, start, b"".join(held))
                    start, need, held, unread = here, None, [cut], True
                else:
                    (lead if start is None else held).extend([magic, cut])
                if unread and HEADER_END in cut:
                    found, unread = head(b"".join(held)), False
                    if found:
                        need = sum(found) + len(TERMINATOR)
                here += len(cut) + size
            if not whole and owner is not None and lead:
                yield row(file, owner, base, b"".join(lead))
            if start is not None and whole == (need is not None and sum(map(len, held)) >= need):
                yield row(file, start, start, b"".join(held))
    return follow


def _fields(data: bytes) -> tuple:
    """type, id, url, refers_to, payload, payload_bytes, digest, intact,
    truncated of one record."""
    found = head(data)
    if found is None:
        return None, None, None, None, data, len(data), None, False, False
    length, content = found if found[0] >= 0 else (len(data), 0)
    named = {}
    for line in data[:length].decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        named.setdefault(name.strip().lower(), value.strip())
    body = data[length:length + content]
    truncated = len(body) < content or found[0] < 0
    if named.get("content-type", "").startswith("application/http"):
        body = body.partition(b"\r\n\r\n")[2]
    number = lambda text: int(m[1]) if (m := re.fullmatch(rf"<?{ID_PREFIX}(-?\d+)>?", text or "")) else None
    kind = named.get("warc-type")
    digest = named.get("warc-payload-digest", "").removeprefix("sha1:") or None
    own = base64.b32encode(hashlib.sha1(body).digest()).decode()
    whole = int(n) if (n := named.get(LENGTH_FIELD.lower(), "")).isdecimal() else len(body)
    return (kind, number(named.get("warc-record-id")), named.get("warc-target-uri"), number(named.get("warc-refers-to")),
            body, len(body) if kind == "response" else whole, digest,
            digest is None or kind == "revisit" or digest == own, truncated)


RECORD = ("file string, at long, record_type string, id long, url string, refers_to long, payload binary, "
          "payload_bytes long, digest string, intact boolean, truncated boolean")


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.int64(),
             pa.string(), pa.bool_(), pa.bool_()]
    names = [c.split()[0] for c in RECORD.split(", ")]
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            rows = [(f, a, *_fields(d)) for f, a, d in zip(*(part.column(k).to_pylist() for k in ("file", "at", "data")))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record of the archives under ``path``; columns as in
    ``RECORD``."""
    cuts = _cuts(spark, path)
    chains = stored(cuts.mapInArrow(candidate_chains, "file string, block long, at long, last long, next long"), "chains")
    # one row for each split of the input, which bounds its size
    starts = F.broadcast(true_starts(chains))
    scan = cuts.join(starts, ["file", "block"]).select("file", "block", "cut", "base", "first", "owner")
    raw = "file string, at long, piece long, data binary"
    whole = scan.mapInArrow(_records(True), raw).select("file", "at", "data")
    # records that run over the end of a split: their pieces meet again
    pieces = (scan.mapInArrow(_records(False), raw).groupBy("file", "at")
              .agg(F.sort_array(F.collect_list(F.struct("piece", "data"))).alias("pieces"))
              .select("file", "at", F.aggregate("pieces", F.lit("").cast("binary"),
                                                lambda whole, p: F.concat(whole, p["data"])).alias("data")))
    return whole.union(pieces).mapInArrow(_parse, RECORD)
