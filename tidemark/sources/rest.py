"""Windowed REST ingestion: one raw payload row for each call."""

from __future__ import annotations

import datetime
import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.spi import ConnectorError

RETRIED = (429, 500, 502, 503, 504)  # fixed values: status codes that pass
SCHEMA = "payload string not null, request_url string not null, window_start date, window_end date, _ingested_at timestamp not null"


def _open(url: str) -> str:
    with urllib.request.urlopen(url, timeout=30) as answer:
        return answer.read().decode()


def fetch_json(url: str, params: dict[str, str] | None = None, retries: int = 3, backoff_s: float = 2.0, opener: Callable[[str], str] = _open, sleep: Callable[[float], None] = time.sleep) -> tuple[str, str]:
    """(body, url); passing failures are tried again after 2, 4, 8 times the wait, and a body that isn't JSON is an error."""
    full = f"{url}?{urllib.parse.urlencode(params)}" if params else url
    for attempt in range(retries + 1):
        try:
            body = opener(full)
            break
        except urllib.error.HTTPError as error:
            if error.code not in RETRIED or attempt == retries:
                raise ConnectorError(f"{full}: status {error.code}") from error
        except (urllib.error.URLError, TimeoutError) as error:
            if attempt == retries:
                raise ConnectorError(f"{full}: {error}") from error
        sleep(backoff_s * 2**attempt)
    try:
        json.loads(body)
    except ValueError as error:
        raise ConnectorError(f"{full}: the answer is not JSON") from error
    return body, full


def fetch_window(spark: SparkSession, template: str, as_of: datetime.date, ingested_at: datetime.datetime, lookback_days: int = 7, params: dict[str, str] | None = None, fetch: Callable[..., tuple[str, str]] = fetch_json) -> DataFrame:
    """The payload of the trailing window that ends at as_of; {start} and {end} of the template are its days."""
    start = as_of - datetime.timedelta(days=lookback_days)
    body, url = fetch(template.format(start=start.isoformat(), end=as_of.isoformat()), params)
    return spark.createDataFrame([(body, url, start, as_of, ingested_at)], SCHEMA)
