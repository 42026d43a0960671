"""WARC archives, and their capture index by external merge of sorted runs.

Writing: each task writes one archive of gzip members, a record each, and notes url key, time, place and length of every
record; each RUN_RECORDS records it sorts what it has noted and writes it as a run, a file of sorted blocks of BLOCK_RECORDS. The
committed table of runs has a row for each block: its place in the file and its first and last key.
Merging: the blocks' first keys, sorted, give the bounds of ranges of about RANGE_RECORDS records. A task takes a range,
opens every run that has a block in it and merges them by a loser tree, holding one block of each run. More than FAN_IN runs
are merged in groups first, range by range, whose results are runs again. The ranges are in order, so the index table is in
global order and all captures of a url are one history.
Reading: the index is dealt by archive and sorted by place, so a task reads its archives from one end to the other.

Equal payloads of at least `least` bytes: the record with the largest id is the response, the others are revisits of it.

Defined results: null html is an empty payload; null urls get `about:blank`; equal ids with equal payloads are all
responses if theirs is the largest; a null id is never the response while another id has that payload; other columns are
ignored; an empty table gives an empty index.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import hashlib
import itertools
import re
import zlib
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textmill.llm.common import Scratch, text_slices
from textmill.llm.files import open_input, open_output, open_stream

#: Records in one sorted run.
RUN_RECORDS = 100_000
#: Records in one block of a run: a merge holds a block of each run.
BLOCK_RECORDS = 1_000
#: Records in one range of the merge, roughly.
RANGE_RECORDS = 1_000_000
#: Runs that one task merges.
FAN_IN = 256
#: A table of up to this many groups of equal payloads is broadcast; a larger one is joined by shuffle.
BROADCAST_GROUPS = 100_000
#: Bytes that a reading task asks for at once.
READ_AHEAD = 4 << 20
#: Tasks that read archives, at most.
READERS = 20_000
CAPTURED = "2000-01-01T00:00:00Z"
_HOST = re.compile(r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)(.*)$", re.S)
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def url_key(url: str | None) -> str:
    """Host labels from the right, then path and query: captures of a site sort together. NUL, which parts the fields of a bound, is escaped."""
    url = (url or "").replace("\x00", "%00")
    if not (m := _HOST.match(url)):
        return url
    host = m[1].rpartition("@")[2].lower()
    return f"{','.join(reversed(host.split('.')))}){m[2].partition('#')[0] or '/'}"


def merge_runs(runs: Sequence[Iterable[tuple]]) -> Iterator[tuple]:
    """The items of sorted runs in order, by a loser tree: one comparison for each level and item. Runs are read as they come."""
    sources = [iter(r) for r in runs]
    k = len(sources)
    if not k:
        return
    heads = [next(s, None) for s in sources]
    losers = [-1] * k  # losers[0] is the winner

    def less(a: int, b: int) -> bool:
        """Run a's next item goes before run b's; -1 goes before all, an empty run after all."""
        if a < 0 or b < 0:
            return a < 0
        if heads[a] is None:
            return False
        return heads[b] is None or (heads[a], a) < (heads[b], b)

    def play(run: int) -> None:
        node = (run + k) // 2
        while node:
            if less(losers[node], run):
                losers[node], run = run, losers[node]
            node //= 2
        losers[0] = run

    for run in range(k - 1, -1, -1):
        play(run)
    while (item := heads[losers[0]]) is not None:
        run = losers[0]
        yield item
        heads[run] = next(sources[run], None)
        play(run)


def record(page: int | None, url: str | None, date: str, payload: bytes, refers: int | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the HTTP head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = head + payload if refers is None else head
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_CONTROL.sub(lambda m: f'%{ord(m[0]):02X}', url) if url else 'about:blank'}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers}>"]
    return "\r\n".join([*lines, f"Content-Length: {len(body)}", "", ""]).encode() + body + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and the body after the HTTP head."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    return fields, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), body


INDEX = "urlkey string, date string, page_id long, file string, offset long, length long"
_INDEX = pa.schema([("urlkey", pa.string()), ("date", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
BLOCKS = "run string, block int, rows int, low string, high string"

# A noted record: url key, date, whether it has an id, the id or 0, archive, place, length. Tuples compare in index order.


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    key, date, known, page, file, offset, length = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((key, date, [p if k else None for k, p in zip(known, page, strict=True)], file, offset, length), _INDEX, strict=True)], schema=_INDEX)


def _tuples(batch: pa.RecordBatch) -> list[tuple]:
    return [(k, d, p is not None, p or 0, f, o, n) for k, d, p, f, o, n in zip(*(c.to_pylist() for c in batch.columns), strict=True)]


def _bound(row: tuple) -> str:
    """Url key, date and id of a record as one string that sorts alike."""
    return f"{row[0]}\x00{row[1]}\x00{int(row[2])}{row[3] + (1 << 63):020d}"


def write_run(folder: str, stem: str, rows: Iterable[tuple]) -> list[tuple]:
    """Write sorted records as a run; a row (run, block, rows, low, high) for each block of it."""
    address, out = open_output(folder, stem, ".run")
    found, held = [], []
    with pa.ipc.new_file(out, _INDEX) as writer:
        for row in rows:
            held.append(row)
            if len(held) == BLOCK_RECORDS:
                found.append((address, len(found), len(held), _bound(held[0]), _bound(held[-1])))
                writer.write_batch(_batch(held))
                held = []
        if held:
            found.append((address, len(found), len(held), _bound(held[0]), _bound(held[-1])))
            writer.write_batch(_batch(held))
    out.close()
    return found


def read_run(address: str, blocks: list[int], low: str | None, high: str | None) -> Iterator[tuple]:
    """The records of some blocks of a run, in order, from low on and before high; a block is read when its turn comes."""
    with open_input(address) as source:
        reader = pa.ipc.open_file(source)
        for block in blocks:
            for row in _tuples(reader.get_batch(block)):
                bound = _bound(row)
                if (low is None or bound >= low) and (high is None or bound < high):
                    yield row


def _blocks_batch(found: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*found, strict=True) if found else [()] * 5, kinds, strict=True)], ["run", "block", "rows", "low", "high"])


def originals(pages: DataFrame, scratch: Scratch, least: int) -> DataFrame:
    """digest, refers_to for each payload of `least` bytes that several rows have."""
    digests = pages.select("page_id", F.sha1(F.encode("html", "utf-8")).alias("digest"), F.octet_length("html").alias("n")).filter(F.col("n") >= least)
    groups = digests.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("rows")).filter("rows > 1 and refers_to is not null")
    return scratch.table(groups.drop("rows"), "originals")


def write_archives(pages: DataFrame, scratch: Scratch, least: int = 1000, date: str = CAPTURED) -> DataFrame:
    """Write page_id, url and html; returns the committed table of the runs' blocks."""
    pages = pages.select(pages["page_id"].cast("long"), "url", F.coalesce(pages["html"], F.lit("")).alias("html"))
    groups = originals(pages, scratch, least)
    if (n := groups.count()) <= BROADCAST_GROUPS:
        groups = F.broadcast(groups)
    if n:
        digest = F.when(F.octet_length("html") >= least, F.sha1(F.encode("html", "utf-8")))
        pages = pages.withColumn("digest", digest).join(groups, "digest", "left").drop("digest")
        pages = pages.withColumn("refers_to", F.when(F.col("refers_to").eqNullSafe(F.col("page_id")), None).otherwise(F.col("refers_to")))
    else:
        pages = pages.withColumn("refers_to", F.lit(None).cast("long"))
    folder = scratch.path("archives")
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, offset, noted, part = None, 0, [], TaskContext.get().partitionId()
        for batch in text_slices(batches, "html"):
            for page, url, html, refers in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to")), strict=True):
                if out is None:
                    address, out = open_output(folder, f"part-{part:06d}", ".warc.gz")
                packer = zlib.compressobj(4, zlib.DEFLATED, 31)
                data = packer.compress(record(page, url, date, html.encode(), refers)) + packer.flush()
                out.write(data)
                noted.append((url_key(url), date, page is not None, page or 0, address, offset, len(data)))
                offset += len(data)
                if len(noted) == RUN_RECORDS:
                    yield _blocks_batch(write_run(folder, f"part-{part:06d}", sorted(noted)))
                    noted = []
        if out is not None:
            out.close()
        if noted:
            yield _blocks_batch(write_run(folder, f"part-{part:06d}", sorted(noted)))

    return scratch.table(pages.mapInArrow(write, BLOCKS), "runs")


def _bounds(blocks: DataFrame) -> list[str]:
    """Where the ranges of the merge begin, but the first: one for each RANGE_RECORDS records or so."""
    total = blocks.agg(F.sum("rows").alias("n")).first().n or 0
    many = -(-total // RANGE_RECORDS)
    if many < 2:
        return []
    # a row for each BLOCK_RECORDS records: the lowest first key of each range's blocks
    ranked = blocks.select("low", F.ntile(many).over(W.orderBy("low")).alias("range"))
    return sorted({r.low for r in ranked.groupBy("range").agg(F.min("low").alias("low")).collect()})[1:]


def _merge_pass(blocks: DataFrame, finish, schema: str, group: int | None) -> DataFrame:
    """finish(merged records, range, group) for every range of the runs, or of each group of `group` runs; ranges are in order."""
    spark, bounds = blocks.sparkSession, _bounds(blocks)
    shared_bounds = spark.sparkContext.broadcast(bounds)  # one string for each RANGE_RECORDS records

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = shared_bounds.value
        for batch in batches:
            rows = []
            for run, block, low, high in zip(*(batch.column(c).to_pylist() for c in ("run", "block", "low", "high")), strict=True):
                rows += [(r, run, block) for r in range(bisect.bisect_right(edges, low), bisect.bisect_right(edges, high) + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True) if rows else [()] * 3, (pa.int32(), pa.string(), pa.int32()), strict=True)], ["range", "run", "block"])

    parts = F.pmod(F.xxhash64("run"), F.lit(group)) if group else F.lit(0)
    placed = blocks.mapInArrow(locate, "range int, run string, block int").withColumn("part", parts.cast("int"))
    placed = placed.repartitionByRange(len(bounds) + 1, "range", "part").sortWithinPartitions("range", "part", "run", "block")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, now, runs = shared_bounds.value, None, {}

        def merged() -> Iterator[pa.RecordBatch]:
            at, part = now
            low, high = edges[at - 1] if at else None, edges[at] if at < len(edges) else None
            yield from finish(merge_runs([read_run(r, b, low, high) for r, b in runs.items()]), at, part)

        for batch in batches:
            for at, run, block, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (at, part) != now:
                    if now is not None:
                        yield from merged()
                    now, runs = (at, part), {}
                runs.setdefault(run, []).append(block)
        if now is not None:
            yield from merged()

    return placed.mapInArrow(merge, schema)


def merge_index(blocks: DataFrame, scratch: Scratch) -> DataFrame:
    """The runs as one index in order of url key, date and id (partition after partition)."""
    folder, turn = scratch.path("merged"), 0
    fan = blocks.agg(F.count_distinct("run")).first()[0]  # runs that meet in a range
    while fan > FAN_IN:
        groups = -(-fan // FAN_IN)

        def again(rows: Iterator[tuple], at: int, part: int) -> Iterator[pa.RecordBatch]:
            yield _blocks_batch(write_run(folder, f"merged-{part:06d}-{at:06d}", rows))

        # the files of a group's ranges are runs of their own, no two of which meet in a range
        blocks = scratch.table(_merge_pass(blocks, again, BLOCKS, groups), f"runs{turn}")
        fan, turn = groups, turn + 1

    def rows(merged: Iterator[tuple], at: int, part: int) -> Iterator[pa.RecordBatch]:
        while held := list(itertools.islice(merged, 8192)):
            yield _batch(held)

    return _merge_pass(blocks, rows, INDEX, None)


READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(index: DataFrame) -> DataFrame:
    """What the records at the places in the index say; every archive is read by one task, from end to end."""
    names = [x.split()[0] for x in READ.split(", ")]
    archives = index.agg(F.count_distinct("file")).first()[0]
    places = index.select("file", "offset", "length").repartition(max(1, min(READERS, archives)), "file").sortWithinPartitions("file", "offset")

    def number(field: str) -> int | None:
        digits = field.removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, stream, place = None, None, 0
        for batch in batches:
            rows = []
            for file, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file != now:
                    if stream:
                        stream.close()
                    now, stream, place = file, open_stream(file, READ_AHEAD), 0
                if offset > place:
                    stream.read(offset - place)
                data, place = stream.read(length), offset + length
                fields, http, body = parse(zlib.decompress(data, 31))
                kind = fields["WARC-Type"]
                if kind == "response":
                    size, digest, refers = len(body), hashlib.sha1(body).hexdigest(), None
                else:
                    size, refers = int(http["Content-Length"]), number(fields["WARC-Refers-To"])
                    digest = binascii.hexlify(base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))).decode()
                rows.append((number(fields["WARC-Record-ID"]), size, digest, kind, refers))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True) if rows else [()] * 5, kinds, strict=True)], names)

    return places.mapInArrow(read, READ)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    runs = write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), scratch)
    return read_archives(scratch.table(merge_index(runs, scratch), "index"))


ORACLE_SQL = {
    "op4_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        d AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha1(h) AS payload_digest FROM p),
        m AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS last_id FROM d)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN last_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN last_id = page_id THEN NULL ELSE last_id END AS refers_to
        FROM m"""
}
