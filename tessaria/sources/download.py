"""Downloads that can be stopped and go on: each address once, into a file named by its digest.

Addresses are dealt by host and lane, and a task reads its share one after another, so that it holds
one answer at a time, however many addresses a host has. Each lane keeps to its part of the host's
rate. A body is written under a name of its own and then moved to the address's name: a file that is
there is whole, tasks that are repeated do no harm, and a later run fetches only what is missing.
"""

from __future__ import annotations

import hashlib
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessaria.operators import errors
from tessaria.sources.export import place
from tessaria.sources.files import cut

RESULT = "url string, name string, status string, bytes long, sha256 string, error_type string, error_message string, timestamp string"


class Bucket:
    """Lets ``rate`` requests a second through, after a silence up to ``burst`` at once."""

    def __init__(self, rate: float, burst: int = 1, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rate, self.burst, self.clock, self.sleep = rate, burst, clock, sleep
        self.tokens, self.last = float(burst), clock()

    def take(self) -> None:
        while True:
            now = self.clock()
            self.tokens, self.last = min(self.burst, self.tokens + (now - self.last) * self.rate), now
            if self.tokens >= 1 - 1e-9:
                self.tokens -= 1
                return
            self.sleep((1 - self.tokens) / self.rate)


@dataclass(frozen=True)
class Policy:
    """How a host is treated: requests a second and how many lanes share them, tries and the wait before a second one (doubled for each further), seconds to wait for an answer, and what a body must have."""

    rate: float = 0.5
    lanes: int = 1
    tries: int = 4
    wait: float = 2.0
    timeout: float = 90.0
    least: int = 0
    magic: bytes = b""
    headers: dict = field(default_factory=dict)


def file_name(url: str) -> str:
    digest = hashlib.sha256(url.encode()).hexdigest()
    return f"{digest[:2]}/{digest}"


def get(url: str, policy: Policy, bucket: Bucket, sleep: Callable[[float], None] = time.sleep) -> tuple[bytes | None, str | None, str | None]:
    """(body, error type, message) of an address: http_status, unreachable, bad_address, invalid_content or small_content.

    Statuses from 500 on, 408 and 429, and failures on the way are tried again; others tell all there is.
    """
    kind = message = None
    for attempt in range(policy.tries):
        if attempt:
            sleep(policy.wait * 2 ** (attempt - 1))
        bucket.take()
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers=policy.headers), timeout=policy.timeout) as answer:
                body = answer.read()
            if not body.startswith(policy.magic):
                return None, "invalid_content", f"begins with {body[: len(policy.magic)]!r}"
            if len(body) < policy.least:
                return None, "small_content", f"{len(body)} bytes"
            return body, None, None
        except urllib.error.HTTPError as e:
            kind, message = "http_status", str(e.code)
            if e.code < 500 and e.code not in (408, 429):
                break
        except ValueError as e:  # no address at all
            return None, "bad_address", str(e)
        except OSError as e:
            kind, message = "unreachable", str(e)
    return None, kind, message


def _fetcher(out: str, policy: Policy) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = place(out)
        buckets: dict[str, Bucket] = {}
        for batch in batches:
            for host, url in zip(batch["host"], batch["url"], strict=True):
                if host not in buckets:
                    buckets = {host: Bucket(policy.rate / policy.lanes)}  # rows come host by host
                name = file_name(url)
                row = dict(url=url, name=name, status="present", bytes=None, sha256=None, error_type=None, error_message=None, timestamp=time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()))
                there = system.get_file_info(f"{root}/{name}")
                if there.type == fs.FileType.File:
                    row["bytes"] = there.size
                else:
                    body, kind, message = get(url, policy, buckets[host])
                    if body is None:
                        row |= {"status": "error", "error_type": kind, "error_message": message}
                    else:
                        system.create_dir(f"{root}/{name[:2]}")
                        own = f"{root}/{name}.{uuid.uuid4().hex}.new"
                        with system.open_output_stream(own) as f:
                            f.write(body)
                        system.move(own, f"{root}/{name}")
                        row |= {"status": "fetched", "bytes": len(body), "sha256": hashlib.sha256(body).hexdigest()}
                yield pd.DataFrame([row])

    return run


def download(rows: DataFrame, out: str, policy: Policy | None = None, url_col: str = "url") -> DataFrame:
    """(url, name, status, bytes, sha256, error_type, error_message, timestamp) of the distinct addresses of ``rows``.

    Bodies are below ``out`` under ``name``. Status: fetched, present (from an earlier run: no request
    is made) or error. Null and blank addresses are left out. The result is written where it is
    made, so reading it again fetches nothing.
    """
    policy = policy or Policy()
    urls = rows.select(F.trim(F.col(url_col)).alias("url")).filter("url != ''").distinct()
    urls = urls.withColumn("host", F.coalesce(F.expr("try_parse_url(url, 'HOST')"), F.lit(""))).withColumn("lane", F.pmod(F.xxhash64("url"), F.lit(policy.lanes)))
    dealt = urls.repartition("host", "lane").sortWithinPartitions("host", "url").select("host", "url")
    return cut(dealt.mapInPandas(_fetcher(out.rstrip("/"), policy), RESULT))


def attach(rows: DataFrame, results: DataFrame, url_col: str = "url") -> DataFrame:
    """``rows`` with ``file`` and ``fetch_error`` of their address: every row that shares an address gets its file."""
    own = results.select(F.col("url").alias("r_url"), F.when(F.col("status") != "error", F.col("name")).alias("file"), F.col("error_type").alias("fetch_error"))
    return rows.drop("file", "fetch_error").join(own, F.trim(F.col(url_col)) == F.col("r_url"), "left").drop("r_url")


def failures(rows: DataFrame, results: DataFrame, key: Column, document_type: Column, url_col: str = "url") -> DataFrame:
    """The error table's rows (``errors.COLUMNS``) of addresses that failed: one for each row that wanted one."""
    wrong = results.filter("status = 'error'").select(F.col("url").alias("r_url"), "error_type", "error_message", "timestamp")
    wanted = rows.select(key.alias("orgao_sigla"), document_type.alias("document_type"), F.trim(F.col(url_col)).alias("url"))
    return errors.together(wanted.join(wrong, F.col("url") == F.col("r_url")).withColumn("stage", F.lit("download")))
