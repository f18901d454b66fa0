"""WARC archives and their capture index (operator 9).

Write: one record per page, formed as text by Spark, one gzip member a record (so that a
record can be read from its offset), in archives that are closed at ARCHIVE_BYTES. Equal
payloads become ``revisit`` records of the capture with the largest id.

Read: an external merge. Every archive is streamed, record by record; its captures are
sorted RUN_ROWS at a time by URL key and time and written as runs of small batches, with
the first key of each batch as a sparse index. The index is cut into ranges of the key; a
range is merged by one task, which reads of every run only the batches that reach into the
range, one at a time, through a loser tree. So the table of captures is globally ordered,
and no task holds more than a batch of each of MAX_WAY runs; of more runs it merges
MAX_WAY at a time into new ones first.

Archives and runs of tasks that were lost lie unnamed in the shared folder and are not read.
"""

from __future__ import annotations

import bisect
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import join_group_facts, open_store, shuffle_partitions, stored

CRLF = "\r\n"
ARCHIVE_BYTES = 256 << 20    # an archive is closed when it has grown past this
RUN_ROWS = 200_000           # captures sorted at once
RUN_BATCH = 4096             # captures of a batch of a run, and of an entry of the sparse index
MAX_WAY = 256                # runs merged at once
MANIFEST = "_archives"       # table of the archives that were written, beside them
REVISIT_MIN_BYTES = 1000
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
#: Pages carry no capture time: capture ``id`` is dated this many seconds after EPOCH.
EPOCH, DATE_CYCLE = 1_704_067_200, 315_360_000

RUN_SCHEMA = ("urlkey string, warc_date string, page_id long, payload_bytes long, payload_digest string, "
              "record_type string, refers_to long, archive string, record_offset long")
RUN_COLUMNS = [c.split()[0] for c in RUN_SCHEMA.split(", ")]


# ------------------------------------------------------------------ writing

def revisits(pages: DataFrame, min_bytes: int = REVISIT_MIN_BYTES) -> DataFrame:
    """(page_id, sha, refers_to) of the pages that repeat a payload."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    digests = stored(pages.select(
        "page_id", F.unhex(F.sha1(payload)).alias("sha"), F.octet_length(payload).alias("bytes")), "warc-digests")
    large = digests.where(F.col("bytes") >= min_bytes).drop("bytes")
    groups = (large.groupBy("sha").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("copies"))
              .where("copies > 1 and refers_to is not null"))
    groups = stored(groups, "warc-groups")
    return (join_group_facts(large, groups, "sha", "copies", digests.count())
            .where("page_id is null or page_id < refers_to").select("page_id", "sha", "refers_to").distinct())


def record_text() -> F.Column:
    """One WARC record without its last CRLF, from page_id, url, payload, sha, refers_to."""
    def header(name, value):
        return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))).otherwise(F.lit(""))

    is_revisit = F.col("refers_to").isNotNull()
    page = F.col("page_id").cast("string")
    date = F.date_format(F.timestamp_seconds(F.lit(EPOCH) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(DATE_CYCLE))),
                         "yyyy-MM-dd'T'HH:mm:ss'Z'")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.octet_length("payload").cast("string"), F.lit(CRLF + CRLF))
    block = F.when(is_revisit, http).otherwise(F.concat(http, F.col("payload")))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit(f"WARC/1.0{CRLF}WARC-Type: "), F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit(CRLF), header("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(page, F.lit("")), F.lit(">"))),
        header("WARC-Target-URI", url), header("WARC-Date", date),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.lower(F.hex("sha")))),
        F.when(is_revisit, F.concat(F.lit(f"WARC-Profile: {REVISIT_PROFILE}{CRLF}WARC-Refers-To: <urn:page:"),
                                    F.col("refers_to").cast("string"), F.lit(f">{CRLF}"))).otherwise(F.lit("")),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}Content-Length: "),
        F.octet_length(block).cast("string"), F.lit(CRLF + CRLF), block, F.lit(CRLF))


def write_warc(pages: DataFrame, path: str, min_bytes: int = REVISIT_MIN_BYTES) -> str:
    """Write ``page_id, url, html`` as gzip WARC archives under ``path``, and the table of them.

    NULL html is an empty payload, a NULL url leaves WARC-Target-URI out, line
    breaks in a url are percent-encoded. Rows that repeat both page_id and payload
    are written as they are, none revisiting the other; other columns are ignored."""
    refer = revisits(pages, min_bytes).withColumnsRenamed({"page_id": "_id", "sha": "_sha"})
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumn("sha", F.unhex(F.sha1("payload")))
    joined = rows.join(refer, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("sha") == F.col("_sha")), "left")
    written = joined.select(record_text().alias("value")).mapInArrow(_write_archives(path), "archive string, n_records long, n_bytes long")
    written.write.parquet(f"{path}/{MANIFEST}")
    return path


def _write_archives(folder: str):
    """mapInArrow: record texts to archives; a row for each that is whole."""
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        prefix, part, sink, done = f"pages-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}", 0, None, []
        for batch in batches:
            for value in batch["value"].cast(pa.binary()):
                if sink is None:
                    name, n, size = f"{prefix}-{part:04d}.warc.gz", 0, 0
                    sink = store.open_output_stream(f"{base}/{name}", compression=None)
                member = zlib.compressobj(6, zlib.DEFLATED, 31)
                record = member.compress(value.as_py() + b"\r\n") + member.flush()
                sink.write(record)
                n, size = n + 1, size + len(record)
                if size >= ARCHIVE_BYTES:
                    sink.close()
                    sink, part = None, part + 1
                    done.append((name, n, size))
        if sink is not None:
            sink.close()
            done.append((name, n, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["archive", "n_records", "n_bytes"])
    return run


# ------------------------------------------------------------------ reading

class _Member(io.RawIOBase):
    """Decompressed bytes of one gzip member; the file goes on behind it."""

    def __init__(self, source: _Source):
        self.source, self.unzip = source, zlib.decompressobj(31)

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        while not self.unzip.eof:
            data = self.source.take()
            if not data:
                raise ValueError("archive is cut off")
            out = self.unzip.decompress(data, len(into))
            self.source.give_back(self.unzip.unused_data if self.unzip.eof else self.unzip.unconsumed_tail)
            if out:
                into[:len(out)] = out
                return len(out)
        return 0


class _Source:
    """A file read in blocks, of which what was not used is given back."""

    def __init__(self, file):
        self.file, self.rest, self.at = file, b"", 0

    def take(self) -> bytes:
        data, self.rest = self.rest or self.file.read(1 << 16), b""
        self.at += len(data)
        return data

    def give_back(self, data: bytes) -> None:
        self.rest = data
        self.at -= len(data)


def members(file) -> Iterator[tuple[int, io.BufferedReader]]:
    """(offset, content) of every gzip member of a file; a file that is not gzip is one."""
    source = _Source(file)
    while head := source.take():
        source.give_back(head)
        if head[:1] != b"\x1f":
            if source.at:
                raise ValueError(f"no gzip member at {source.at}")
            yield 0, io.BufferedReader(_Plain(source))
            return
        at, content = source.at, io.BufferedReader(_Member(source))
        yield at, content
        while content.read(1 << 16):
            pass


class _Plain(io.RawIOBase):
    def __init__(self, source: _Source):
        self.source = source

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        data = self.source.take()
        self.source.give_back(data[len(into):])
        into[:len(data[:len(into)])] = data[:len(into)]
        return len(data[:len(into)])


def parse_records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of every record."""
    while line := stream.readline():
        if line.rstrip() == b"":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record: {line[:40]!r}")
        fields = {}
        while (line := stream.readline()).rstrip():
            name, _, value = line.decode().partition(":")
            fields[name.lower()] = value.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a record is cut off")
        yield fields, block


def parse_archive(file) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset of its gzip member, header fields, block) of every record, one at a time."""
    for at, content in members(file):
        for fields, block in parse_records(content):
            yield at, fields, block


def url_key(url: str | None) -> str:
    """Sort key of a URL: host labels reversed, then the rest; scheme dropped."""
    if not url:
        return ""
    rest = url.partition("://")[2] or url
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    return ",".join(reversed(rest[:cut].lower().split("."))) + ")" + rest[cut:]


def capture(archive: str, offset: int, fields: dict[str, str], block: bytes) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    number = lambda s: int(s) if (s := s.removeprefix("<urn:page:").rstrip(">")) else None
    if kind == "response":
        size, own = len(payload), hashlib.sha1(payload).hexdigest()
        if own != digest:
            raise ValueError(f"{archive}: payload digest differs at {offset}")
    else:
        size = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    return (url_key(fields.get("warc-target-uri")), fields["warc-date"], number(fields["warc-record-id"]), size, digest,
            kind, number(fields["warc-refers-to"]) if "warc-refers-to" in fields else None, archive, offset)


def run_order(row: tuple) -> tuple:
    return (row[0], row[1], row[2] is not None, row[2] or 0, row[7], row[8])


def _batch(rows: list[tuple], schema):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)


def _arrow_schema():
    import pyarrow as pa

    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in RUN_SCHEMA.split(", ")])


def _read_archives(folder: str):
    """mapInArrow: archive names to their captures."""
    def run(batches: Iterable) -> Iterator:
        schema, (store, base) = _arrow_schema(), open_store(folder)
        for batch in batches:
            for name in batch["archive"].to_pylist():
                rows = []
                with store.open_input_stream(f"{base}/{name}", compression=None) as file:
                    for record in parse_archive(file):
                        rows.append(capture(name, *record))
                        if len(rows) == 10_000:
                            yield _batch(rows, schema)
                            rows = []
                if rows:
                    yield _batch(rows, schema)
    return run


KEY_DDL = "urlkey string, warc_date string, has_id boolean, id long, archive string, record_offset long"
INDEX_DDL = f"run string, batch int, first struct<{KEY_DDL.replace(' ', ':').replace(',:', ',')}>, last struct<{KEY_DDL.replace(' ', ':').replace(',:', ',')}>"
KEY_NAMES = [c.split()[0] for c in KEY_DDL.split(", ")]


def write_run(store, base: str, rows: Iterable[tuple]) -> list[dict]:
    """Sorted captures to a file of batches; their sparse index."""
    import pyarrow as pa

    schema, name, index, part = _arrow_schema(), f"run-{uuid.uuid4().hex}.arrow", [], []
    small = pa.ipc.IpcWriteOptions(compression="zstd")
    with store.open_output_stream(f"{base}/{name}", compression=None) as sink, pa.ipc.new_file(sink, schema, options=small) as out:
        def flush():
            out.write_batch(_batch(part, schema))
            first, last = (dict(zip(KEY_NAMES, run_order(r))) for r in (part[0], part[-1]))
            index.append({"run": name, "batch": len(index), "first": first, "last": last})
            part.clear()

        for row in rows:
            part.append(row)
            if len(part) == RUN_BATCH:
                flush()
        if part:
            flush()
    return index


def _sorted_runs(folder: str):
    """mapInArrow: captures to runs of RUN_ROWS; the runs' sparse index."""
    def run(batches: Iterable) -> Iterator:
        store, base = open_store(folder)
        store.create_dir(base, recursive=True)
        rows: list[tuple] = []
        for batch in batches:
            rows += zip(*(batch[c].to_pylist() for c in RUN_COLUMNS))
            while len(rows) >= RUN_ROWS:
                yield _index_batch(write_run(store, base, sorted(rows[:RUN_ROWS], key=run_order)))
                rows = rows[RUN_ROWS:]
        if rows:
            yield _index_batch(write_run(store, base, sorted(rows, key=run_order)))
    return run


def _index_schema():
    import pyarrow as pa

    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    key = pa.struct([(c.split()[0], kinds[c.split()[1]]) for c in KEY_DDL.split(", ")])
    return pa.schema([("run", pa.string()), ("batch", pa.int32()), ("first", key), ("last", key)])


def _index_batch(index: list[dict]):
    import pyarrow as pa

    return pa.RecordBatch.from_pylist(index, schema=_index_schema())


def merge_runs(runs: list[Iterable], key) -> Iterator:
    """k-way merge by a loser tree: inner nodes hold the loser of their match, and
    the run of the last winner replays only its path to the root."""
    k = len(runs)
    if k == 0:
        return
    sources = [iter(r) for r in runs]
    rows = [next(r, None) for r in sources]
    heads = [None if r is None else key(r) for r in rows]

    def beats(a: int, b: int) -> bool:  # an ended run loses to every other
        return heads[a] is not None and (heads[b] is None or (heads[a], a) < (heads[b], b))

    tree, winners = [0] * k, [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], tree[node] = (a, b) if beats(a, b) else (b, a)
    best = winners[1] if k > 1 else 0
    while heads[best] is not None:
        yield rows[best]
        rows[best] = next(sources[best], None)
        heads[best] = None if rows[best] is None else key(rows[best])
        node = (best + k) // 2
        while node:
            if beats(tree[node], best):
                best, tree[node] = tree[node], best
            node //= 2


def _cursor(store, base: str, name: str, numbers: list[int], low: tuple | None, high: tuple | None) -> Iterator[tuple]:
    """Captures of some batches of a run with ``low <= key < high``, a batch at a time."""
    import pyarrow as pa

    with store.open_input_file(f"{base}/{name}") as file:
        run = pa.ipc.open_file(file)
        for i in numbers:
            batch = run.get_batch(i)
            for row in zip(*(batch[c].to_pylist() for c in RUN_COLUMNS)):
                key = run_order(row)
                if (low is None or key >= low) and (high is None or key < high):
                    yield row


def _merged(folder: str, bounds: list[tuple]):
    """mapInArrow over (range, run, batch) sorted: the captures of each range in order."""
    def run(batches: Iterable) -> Iterator:
        import itertools

        schema, (store, base) = _arrow_schema(), open_store(folder)
        entries = (r for b in batches for r in zip(b["range"].to_pylist(), b["run"].to_pylist(), b["batch"].to_pylist()))
        for number, own in itertools.groupby(entries, key=lambda r: r[0]):
            low, high = bounds[number - 1] if number else None, bounds[number] if number < len(bounds) else None
            runs = [(name, [r[2] for r in group]) for name, group in itertools.groupby(own, key=lambda r: r[1])]
            while len(runs) > MAX_WAY:
                index = write_run(store, base, merge_runs([_cursor(store, base, *r, low, high) for r in runs[:MAX_WAY]], run_order))
                runs = runs[MAX_WAY:] + ([(index[0]["run"], list(range(len(index))))] if index else [])
            out: list[tuple] = []
            for row in merge_runs([_cursor(store, base, *r, low, high) for r in runs], run_order):
                out.append(row)
                if len(out) == 10_000:
                    yield _batch(out, schema)
                    out = []
            if out:
                yield _batch(out, schema)
    return run


def _ranges(bounds: list[tuple]):
    """mapInArrow: index entries to the ranges that their batch reaches into."""
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = []
            for name, number, first, last in zip(*(batch[c].to_pylist() for c in ("run", "batch", "first", "last"))):
                a, b = (bisect.bisect_right(bounds, tuple(x[c] for c in KEY_NAMES)) for x in (first, last))
                out += [(r, name, number) for r in range(a, b + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 3, (pa.int32(), pa.string(), pa.int32()))],
                                             ["range", "run", "batch"])
    return run


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Captures of all archives under ``path``, in the order of (urlkey, warc_date, page_id).

    Archives are those of the folder's table of archives or, without one, all its ``.gz`` and
    ``.warc`` files. The driver gets the bounds of the ranges, one fewer than shuffle partitions."""
    parts, runs = shuffle_partitions(spark), scratch_path(spark, "warc-runs")
    try:
        archives = spark.read.schema("archive string").parquet(f"{path}/{MANIFEST}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        files = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", "[^/]*$", 0).alias("archive"))
        archives = files.where(F.col("archive").rlike(r"\.gz$|\.warc$"))
    captures = archives.repartition(parts, "archive").mapInArrow(_read_archives(path), RUN_SCHEMA)
    index = stored(captures.mapInArrow(_sorted_runs(runs), INDEX_DDL), "warc-index")
    cut = index.select("first").repartitionByRange(parts, "first").groupBy(F.spark_partition_id().alias("p")).agg(F.min("first").alias("first"))
    bounds = sorted(tuple(r.first) for r in cut.select("first").collect())[1:]
    dealt = index.mapInArrow(_ranges(bounds), "range int, run string, batch int")
    dealt = dealt.repartitionByRange(parts, "range").sortWithinPartitions("range", "run", "batch")
    return dealt.mapInArrow(_merged(runs, bounds), RUN_SCHEMA)


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives in a scratch folder and read them back."""
    spark = pages.sparkSession
    return read_warc(spark, write_warc(pages, scratch_path(spark, "warc")))
