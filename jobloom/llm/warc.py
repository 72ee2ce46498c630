"""Deterministic sharded WARC writer and its reader.

Records are range-sorted by (url, id, digest): range bounds come from the keys with the smallest hashes, so
they depend on the rows alone and the same table always gives the same files, byte for byte. There are at most
``MOST_RANGES`` ranges, of about ``shard_bytes`` below that number and growing beyond it. Each range is written by one task as gzip
members, and a file rolls when its compressed size passes ``roll_bytes``.
Headers and digests are made anew for every record. A file is written under a temporary name and renamed
when whole; the names, sizes and digests that count are listed in a manifest that Spark commits last, so
what a lost or repeated task leaves behind is never read and a second attempt only renames the same bytes.

Records with equal payloads of at least ``least_bytes`` are written once, as the one with the largest id, and as
``revisit`` otherwise. Representatives are found by a grouped maximum over digests, combined before the
shuffle.

Files go to any folder that all executors share and ``pyarrow.fs`` can open (a mounted path, object store or
HDFS). Defined cases: a null payload is empty; a null url leaves out the target header; a null id is allowed and loses
against any other id; repeated rows give repeated records (all rows that tie for the largest id are responses); an empty
table gives a manifest without files; other columns are not read. Very many rows equal in all are written by several tasks.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from bisect import bisect_right
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import hot_rows, join_hot, shared_dir, stash

MOST_RANGES, MOST_SAMPLED = 1 << 16, 1_000_000
#: What a record is reckoned at besides its payload.
RECORD_BYTES = 512
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "name string, records long, bytes long, sha256 string"
READ = "id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def _open(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else "file://" + folder)


def _b32(hexed: str) -> str:
    return base64.b32encode(bytes.fromhex(hexed)).decode()


def _record_id(kind: str, id_, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{kind}/{id_}/{digest}')}>"


def _member(headers: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(VERSION + head.encode() + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def make_record(id_, url, payload: bytes, refers_to, revisit: bool, date: str, level: int = 6) -> bytes:
    """One gzip member. Digests are computed here from the payload and the block."""
    digest = hashlib.sha1(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id("page", id_, digest)), ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe="/:?#[]@!$&'()*+,;=%~")))
    if id_ is not None:
        headers.append(("X-Source-Id", str(id_)))
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id("page", refers_to, digest)), ("X-Refers-To-Source-Id", str(refers_to))]
    headers += [("WARC-Payload-Digest", f"sha1:{_b32(digest)}"), ("WARC-Block-Digest", f"sha1:{_b32(hashlib.sha1(block).hexdigest())}"), ("Content-Type", "application/http; msgtype=response")]
    return _member(headers, block, level)


class _Roller:
    """Writes the members of one range to files that roll by compressed size."""

    def __init__(self, folder: str, shard: int, roll_bytes: int, date: str):
        self.fs, self.root = _open(folder)
        self.shard, self.roll_bytes, self.date = shard, roll_bytes, date
        self.seq, self.out = 0, None

    def _begin(self):
        self.name = f"part-{self.shard:05d}-{self.seq:05d}.warc.gz"
        self.temp = f"{self.root}/_temporary/{uuid.uuid4().hex}-{self.name}"
        self.fs.create_dir(f"{self.root}/_temporary", recursive=True)
        self.out, self.bytes, self.records, self.sha = self.fs.open_output_stream(self.temp, compression=None), 0, 0, hashlib.sha256()
        info = b"software: jobloom\r\nformat: WARC File Format 1.1\r\n"
        self._put(_member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id("file", self.name, "")), ("WARC-Date", self.date), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], info, 6))

    def _put(self, member: bytes):
        self.out.write(member)
        self.sha.update(member)
        self.bytes += len(member)

    def write(self, member: bytes):
        done = None
        if self.out is not None and self.bytes + len(member) > self.roll_bytes:
            done = self.finish()
        if self.out is None:
            self._begin()
        self._put(member)
        self.records += 1
        return done

    def finish(self):
        if self.out is None:
            return None
        self.out.close()
        self.fs.move(self.temp, f"{self.root}/{self.name}")
        self.out, self.seq = None, self.seq + 1
        return self.name, self.records, self.bytes, self.sha.hexdigest()


def _bounds(keys: DataFrame, rows: int, shards: int, per_shard: int = 64) -> list:
    """At most ``shards - 1`` range bounds: quantiles of the distinct keys with the smallest hashes, about ``per_shard`` for
    each range and at most about ``MOST_SAMPLED``, so they depend on the keys alone and what the driver holds is bounded."""
    if shards <= 1:
        return []
    least = int(min(1.0, min(shards * per_shard, MOST_SAMPLED) / rows) * (1 << 30))
    sample = keys.where(F.pmod(F.xxhash64("url", "id", "digest"), F.lit(1 << 30)) <= least).distinct().collect()
    ordered = sorted((r.url.encode(), r.id, r.digest) for r in sample)
    return sorted({ordered[len(ordered) * i // shards] for i in range(1, shards)}) if ordered else []


def _ranges(sized: DataFrame, total: int, rows: int, shard_bytes: int) -> tuple[list, list[int], dict]:
    """Bounds of the ranges of ``sized(url, id, digest, bytes)``, the first shard of each (one entry more), and the rows of heavy keys.

    A key that alone is more than two ranges' worth, that is many rows equal in all, has a range of its own of several shards. There are at
    most half as many such keys as ranges.
    """
    shards = min(total // shard_bytes + 1, MOST_RANGES)
    worth = max(shard_bytes, total // shards)
    bounds = _bounds(sized.select("url", "id", "digest"), rows, int(shards))
    heavy = sized.groupBy("url", "id", "digest").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("rows")).where((F.col("bytes") > 2 * worth) & (F.col("rows") > 1))
    heavy = heavy.collect() if total > 2 * worth else []
    own = {(r.url.encode(), r.id, r.digest): min(r.rows, -(-r.bytes // worth)) for r in heavy}
    bounds = sorted({*bounds, *own, *((u, i, d + "\0") for u, i, d in own)})
    firsts = [0]
    for begin in [None, *bounds]:
        firsts.append(firsts[-1] + own.get(begin, 1))
    return bounds, firsts, {(r.url, r.id, r.digest): r.rows for r in heavy}


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 1000, shard_bytes: int = 32 << 20, roll_bytes: int = 16 << 20, date: str = "2024-01-01T00:00:00Z", level: int = 6) -> DataFrame:
    """Write every row of ``pages`` as a WARC record below ``folder``; returns the committed manifest.

    ``shard_bytes`` is the mean payload of a range; each range is one task, which holds one Arrow batch.
    """
    spark = pages.sparkSession
    rows = pages.select(pages[id_col].cast("long").alias("id"), pages[url_col].alias("url"), F.coalesce(pages[payload_col], F.lit("")).alias("payload"))
    sized = rows.select("id", F.coalesce("url", F.lit("")).alias("url"), F.octet_length("payload").cast("long").alias("bytes"), F.sha1("payload").alias("digest"))
    sized = stash(sized, "sizes")
    total, n_rows = sized.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count("*")).first()
    first = sized.where(F.col("bytes") >= least_bytes).groupBy("digest", "bytes").agg(F.max("id").alias("response"), F.count("*").alias("n")).where("n > 1")
    low = F.coalesce("id", F.lit(-(1 << 63)))
    revisits = join_hot(sized, stash(first, "copies"), ["digest", "bytes"], F.col("n") >= hot_rows(n_rows)).where(~F.col("id").eqNullSafe(F.col("response")))
    framed = F.col("bytes") + RECORD_BYTES
    bounds, firsts, heavy = _ranges(sized.select("url", low.alias("id"), "digest", framed.alias("bytes")), int(total) + RECORD_BYTES * n_rows, n_rows, shard_bytes)

    # What to refer to travels as rows of its own, sorted just before the records it is for, so that the
    # payloads are shuffled once.
    named = lambda df, **more: df.select(low.alias("key"), F.coalesce("url", F.lit("")).alias("u"), "digest", *[v.alias(k) for k, v in more.items()])
    nothing = F.lit(None)
    notes = named(revisits, turn=F.lit(0), copies=F.lit(0), id=F.col("id"), url=nothing.cast("string"), payload=nothing.cast("string"), refers_to=F.col("response")).distinct()
    rows = named(rows.withColumn("digest", F.sha1("payload")), turn=F.lit(1), copies=F.lit(1), id=F.col("id"), url=F.col("url"), payload=F.col("payload"), refers_to=nothing.cast("long"))

    @F.pandas_udf("array<int>")
    def shards_of(url: pd.Series, key: pd.Series, digest: pd.Series) -> pd.Series:
        at = (bisect_right(bounds, (u.encode(), k, d)) for u, k, d in zip(url, key, digest))
        return pd.Series([list(range(firsts[i], firsts[i + 1])) for i in at])

    # Of a heavy key, whose rows are equal in all, one row goes to each of its shards with the number of its copies there.
    if heavy:
        few = spark.createDataFrame([(*k, n) for k, n in heavy.items()], "u string, key long, digest string, n long")
        one = rows.join(F.broadcast(few), ["u", "key", "digest"]).groupBy("u", "key", "digest").agg(*[F.first(c).alias(c) for c in rows.columns if c not in ("u", "key", "digest", "copies")], F.max("n").cast("int").alias("copies"))
        rows = rows.join(F.broadcast(few), ["u", "key", "digest"], "left_anti").select(*rows.columns).unionByName(one)
    dealt = rows.union(notes).withColumn("shards", shards_of("u", "key", "digest") if bounds else F.array(F.lit(0)))
    dealt = dealt.select("*", F.size("shards").alias("k"), F.posexplode("shards").alias("nth", "shard"))
    dealt = dealt.withColumn("copies", F.expr("copies div k").cast("int") + F.when(F.col("nth") < F.col("copies") % F.col("k"), 1).otherwise(0)).repartitionById(firsts[-1], F.col("shard"))
    dealt = dealt.sortWithinPartitions("shard", "u", "key", "digest", "turn").select("shard", "turn", "digest", "id", "url", "payload", "refers_to", "copies")

    def run(batches):
        roller, note = None, None
        for pdf in batches:
            done = []
            ids = (pdf[c].astype("Int64").astype(object).where(pdf[c].notna(), None) for c in ("id", "refers_to"))
            for shard, turn, digest, url, payload, copies, id_, refers in zip(pdf["shard"], pdf["turn"], pdf["digest"], pdf["url"], pdf["payload"], pdf["copies"], *ids):
                if turn == 0:
                    note = (shard, digest, id_, refers)
                    continue
                if roller is None or roller.shard != shard:
                    done.append(roller.finish() if roller else None)
                    roller = _Roller(folder, int(shard), roll_bytes, date)
                refers = note[3] if note and note[:3] == (shard, digest, id_) else None
                record = make_record(id_, url, payload.encode(), refers, refers is not None, date, level)
                done += [roller.write(record) for _ in range(copies)]
            yield pd.DataFrame([d for d in done if d], columns=["name", "records", "bytes", "sha256"])
        yield pd.DataFrame([d for d in [roller.finish() if roller else None] if d], columns=["name", "records", "bytes", "sha256"])

    dealt.mapInPandas(run, MANIFEST).write.mode("overwrite").parquet(f"{folder}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


def iter_records(stream, chunk: int = 1 << 20):
    """Yield ``(headers, block)`` of each gzip member of a binary stream, holding one record at a time."""
    unpack, raw, rest = zlib.decompressobj(31), bytearray(), b""
    while True:
        data = rest or stream.read(chunk)
        if not data:
            break
        raw += unpack.decompress(data)
        rest = b""
        if unpack.eof:
            rest, unpack = unpack.unused_data, zlib.decompressobj(31)
            head, _, block = bytes(raw).partition(b"\r\n\r\n")
            raw = bytearray()
            headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            yield headers, block[: int(headers["Content-Length"])]


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The response and revisit records of the files in ``folder``'s manifest; wrong digests raise."""
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")
    n = max(1, min(files.count(), 10_000))

    def run(batches):
        fs, root = _open(folder)
        for pdf in batches:
            for name in pdf["name"]:
                rows = []
                with fs.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for h, block in iter_records(stream):
                        if h["WARC-Type"] not in ("response", "revisit"):
                            continue
                        if f"sha1:{_b32(hashlib.sha1(block).hexdigest())}" != h["WARC-Block-Digest"]:
                            raise ValueError(f"{name}: block digest of {h['WARC-Record-ID']} is wrong")
                        http, _, payload = block.partition(b"\r\n\r\n")
                        length = int(http.rpartition(b"Content-Length: ")[2])
                        digest = base64.b32decode(h["WARC-Payload-Digest"][5:]).hex()
                        if h["WARC-Type"] == "response" and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
                            raise ValueError(f"{name}: payload of {h['WARC-Record-ID']} is wrong")
                        number = lambda k: int(h[k]) if k in h else None  # noqa: B023, E731
                        rows.append((number("X-Source-Id"), h.get("WARC-Target-URI"), length, digest, h["WARC-Type"], number("X-Refers-To-Source-Id")))
                        if len(rows) >= 5000:
                            yield _frame(rows)
                            rows = []
                yield _frame(rows)

    return files.select("name").repartition(n, "name").mapInPandas(run, READ)


def _frame(rows: list) -> pd.DataFrame:
    pdf = pd.DataFrame(rows, columns=["id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])
    return pdf.astype({"id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})


def archive_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/jobloom-{uuid.uuid4().hex}/warc"


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> last THEN last END AS refers_to
FROM r
"""
