"""WARC archives and a capture index merged from sorted runs.

Each page becomes a WARC record, a member of its own in a gzip file.  A payload
of ``LEAST_REVISIT`` bytes or more that another page with a smaller id has, too,
is written as a revisit record that names that page and has no body.

A writer's task makes archives of bounded size, and for each one a run: the
index rows of its records, sorted by URL key and time.  Runs are dealt to
ranges of keys; a task holds the slices of all runs that fall into its range
and merges them with a loser tree, so that the ranges in a row are one globally
ordered capture history.  Ids break ties, so a URL with very many captures
spreads over several ranges.

Everything that the query returns comes from the archives: records are read
back by offset, their payloads checked against their digests.

Defined cases: a null html is an empty payload.  A null url has the key "".
Pages with the same id and payload: each is a record; a revisit refers to the
least id, so such a pair are both responses.  A null id never is referred to.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spanloom.llm.common import long_array, materialize, release, shared_dir, table
from spanloom.llm.tokenbits import opened, put

LEAST_REVISIT = 100
ARCHIVE_BYTES = 8 << 20
EPOCH = datetime(2024, 1, 1, tzinfo=UTC)
LAST_SECOND = 250_000_000_000
RUN = "run string, turn long, page_id long, url_key string, captured string, path string, offset long, length long"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url_key string, captured string, history_order long, path string, offset long, length long, range int"


def url_key(url: str | None) -> str:
    """Host labels from the top level down, then path and query, all in lower case."""
    if not url:
        return ""
    try:
        parts = urlsplit(url.strip())
        host = parts.hostname or ""
    except ValueError:
        return url.lower()
    host = host.removeprefix("www.")
    return f"{','.join(reversed(host.split('.')))}){parts.path or '/'}{'?' + parts.query if parts.query else ''}".lower()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, captured: str) -> bytes:
    """One gzip member."""
    kind = "response" if refers_to is None else "revisit"
    body = payload if refers_to is None else b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    clean = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", captured),
        ("WARC-Target-URI", clean),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields.append(("Content-Length", str(len(http) + len(body))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return gzip.compress(head.encode("utf-8", "surrogatepass") + http + body + b"\r\n\r\n", 5, mtime=0)


def parse(member: bytes) -> dict:
    """Fields of a record, with payload, payload_bytes, digest, page_id and refers_to."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    http, _, body = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    full = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    number = lambda x: int(x[10:-1]) if x and x[10:-1] else None  # noqa: E731  <urn:page:N>
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "response" and (len(body) != full or hashlib.sha256(body).hexdigest() != digest):
        raise ValueError("a payload doesn't match its digest")
    return {"record_type": fields["WARC-Type"], "page_id": number(fields["WARC-Record-ID"]), "refers_to": number(fields.get("WARC-Refers-To")), "payload_bytes": full, "payload_digest": digest, "payload": body, "url": fields["WARC-Target-URI"], "captured": fields["WARC-Date"]}


class LoserTree:
    """Merges sorted iterators: each inner node keeps the loser of its match, and
    a new head plays only the matches on its way to the top."""

    def __init__(self, runs: list[Iterator], key) -> None:
        self.runs, self.key, self.k = [iter(r) for r in runs], key, len(runs)
        self.heads = [next(r, None) for r in self.runs]
        self.losers = [-1] * max(self.k, 1)
        self.top = self._play(1) if self.k > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        p, q = self.key(x), self.key(y)
        return p < q or p == q and a < b

    def _play(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._play(2 * node), self._play(2 * node + 1)
        winner, self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        return winner

    def __iter__(self):
        while self.k and self.heads[self.top] is not None:
            yield self.heads[self.top]
            self.heads[self.top] = next(self.runs[self.top], None)
            node, winner = (self.top + self.k) // 2, self.top
            while node:
                if self._before(self.losers[node], winner):
                    self.losers[node], winner = winner, self.losers[node]
                node //= 2
            self.top = winner


def captured_at(page_id: int | None) -> str:
    """The tables have no capture time; one second for each id stands for it.  Ids beyond
    ``LAST_SECOND``, where years would need five digits, begin again."""
    return (EPOCH + timedelta(seconds=(page_id or 0) % LAST_SECOND)).strftime("%Y-%m-%dT%H:%M:%SZ")


def write_archives(pages: DataFrame) -> DataFrame:
    """Writes the archives (columns page_id, url, html); the runs of their index rows."""
    spark = pages.sparkSession
    folder = shared_dir(spark)
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    digested = own.withColumn("digest", F.sha2(F.encode("html", "UTF-8"), 256)).withColumn("n", F.octet_length("html").cast("long"))
    firsts = digested.filter(F.col("n") >= LEAST_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("c")).filter("c > 1").select(F.col("digest").alias("d"), "first")
    placed = digested.join(materialize(firsts, "firsts"), F.col("digest") == F.col("d"), "left").select("page_id", "url", "html", "digest", F.when(F.col("first") != F.col("page_id"), F.col("first")).alias("refers_to"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        task = TaskContext.get()
        # a task that runs again writes archives of its own, and only the run that counts is in the index
        part, turn, rows, held, n = f"{task.partitionId():06d}-{task.taskAttemptId()}", 0, [], io.BytesIO(), 0

        def flush() -> pd.DataFrame:
            path = f"{folder}/warc/{part}-{turn:06d}.warc.gz"
            put(path, held.getvalue())
            rows.sort(key=lambda r: (r[1], r[2], r[0] is not None, r[0] or 0, r[3]))
            name = f"{part}-{turn:06d}"
            out = pd.DataFrame([(name, k, None, key, at, path, offset, length) for k, (_, key, at, offset, length) in enumerate(rows)], columns=[c.split()[0] for c in RUN.split(", ")])
            return out.assign(page_id=long_array([r[0] for r in rows]))

        for b in batches:
            for page_id, url, html, digest, refers in zip(b["page_id"], b["url"], b["html"], b["digest"], b["refers_to"], strict=True):
                page_id, refers = (None if x is None else int(x) for x in (page_id, refers))
                at = captured_at(page_id)
                member = record(page_id, url, html.encode("utf-8", "surrogatepass"), digest, refers, at)
                rows.append((page_id, url_key(url), at, n, len(member)))
                held.write(member)
                n += len(member)
                if n >= ARCHIVE_BYTES:
                    yield flush()
                    turn, rows, held, n = turn + 1, [], io.BytesIO(), 0
        if rows:
            yield flush()

    # ids go as strings: a column of longs with a null in it would reach pandas as floating point
    placed.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")}).mapInPandas(run, RUN).write.parquet(f"{folder}/runs")
    del placed, digested
    release(spark)
    return spark.read.parquet(f"{folder}/runs")


def merged_index(runs: DataFrame) -> DataFrame:
    """The runs' rows with range and place: ordered by both, they are globally ordered."""

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, slices, columns = TaskContext.get().partitionId(), {}, None
        for b in batches:
            columns = list(b.columns)
            for row in b.itertuples(index=False, name=None):
                slices.setdefault(row[0], []).append(row)
        if columns is None:
            return
        order = lambda r: (r[3], r[4], r[2] is not None, int(r[2] or 0), r[5], r[6])
        out = []

        def rows() -> pd.DataFrame:
            return pd.DataFrame(out, columns=[*columns, "range", "place"]).assign(page_id=long_array([None if r[2] is None else int(r[2]) for r in out]))

        for place, row in enumerate(LoserTree([iter(slices[k]) for k in sorted(slices)], order)):
            out.append((*row, part, place))
            if len(out) >= 10_000:
                yield rows()
                out = []
        yield rows()

    ranged = runs.repartitionByRange("url_key", "captured", "page_id", "path", "offset").sortWithinPartitions("run", "turn")
    return ranged.withColumn("page_id", F.col("page_id").cast("string")).mapInPandas(merge, RUN + ", range int, place long")


def read_records(index: DataFrame) -> DataFrame:
    """Each record of the index, read back from its archive."""
    sizes = index.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("range").alias("__r"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    placed = index.join(F.broadcast(starts), F.col("range") == F.col("__r")).withColumn("history_order", F.col("first") + F.col("place"))  # a row for each range

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, data = None, b""
        for b in batches:
            rows = []
            for r in b.itertuples(index=False):
                if r.path != path:
                    store, own = opened(r.path)
                    with store.open_input_file(own) as f:
                        path, data = r.path, f.read()
                x = parse(data[r.offset : r.offset + r.length])
                rows.append((x["page_id"], x["payload_bytes"], x["payload_digest"], x["record_type"], x["refers_to"], url_key(x["url"]), x["captured"], r.history_order, r.path, r.offset, r.length, r.range))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in READ.split(", ")]).assign(page_id=long_array([r[0] for r in rows]), refers_to=long_array([r[4] for r in rows]))

    return placed.select("path", "offset", "length", "history_order", "range").repartition(max(1, index.select("path").distinct().count()), "path").sortWithinPartitions("path", "offset").mapInPandas(run, READ)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = materialize(merged_index(write_archives(table(spark, sf_dir, "pages"))), "index")
    return read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "history_order")


ORACLE = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
         regexp_extract(url, '^[^:]+://(www[.])?([^/?#]*)([^?#]*)([?][^#]+)?', ['www', 'host', 'path', 'query']) AS u
  FROM pages),
k AS (
  SELECT *, lower(array_to_string(list_reverse(string_split(u.host, '.')), ',') || ')' || CASE WHEN u.path = '' THEN '/' ELSE u.path END || u.query) AS url_key FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= {LEAST_REVISIT} GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to,
       url_key, row_number() OVER (ORDER BY url_key, page_id) - 1 AS history_order
FROM k LEFT JOIN f USING (payload_digest)
"""
