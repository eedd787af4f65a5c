"""Writing records: to a message stream in batches with retries, and as archived JSON lines."""

from __future__ import annotations

import gzip
import json
import os
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmill.config import DEFAULT

Record = dict
#: Sends (key, payload) pairs; returns for each whether it was taken.
Send = Callable[[list[tuple[str, bytes]]], list[bool]]


def _chunks(rows: Iterable[Record], size: int) -> Iterator[list[Record]]:
    chunk: list[Record] = []
    for r in rows:
        chunk.append(r)
        if len(chunk) == size:
            yield chunk
            chunk = []
    if chunk:
        yield chunk


@dataclass
class MessageWriter:
    """Sends records keyed by vehicle in batches; of a batch only what was refused is sent again,
    after a pause that grows with each attempt."""

    send: Send
    batch: int = DEFAULT.write_batch
    attempts: int = DEFAULT.write_attempts
    pause_s: float = 0.5
    sleep: Callable[[float], None] = time.sleep

    def write(self, records: Iterable[Record]) -> int:
        written = 0
        for chunk in _chunks(records, self.batch):
            left = [(str(r["vehicle_id"]), json.dumps(r).encode()) for r in chunk]
            for attempt in range(self.attempts):
                if attempt:
                    self.sleep(self.pause_s * attempt)
                taken = self.send(left)
                written += sum(taken)
                left = [x for x, ok in zip(left, taken, strict=True) if not ok]
                if not left:
                    break
        return written


def write_messages(df: DataFrame, make_send: Callable[[], Send], **options) -> None:
    """A DataFrame's rows through one writer for each partition; ``make_send`` runs on the executor."""

    def run(rows: Iterator) -> None:
        MessageWriter(make_send(), **options).write(r.asDict(recursive=True) for r in rows)

    df.foreachPartition(run)


def object_key(at: datetime, count: int) -> str:
    return f"year={at:%Y}/month={at:%m}/day={at:%d}/hour={at:%H}/positions_{at:%Y%m%dT%H%M%S}_{count}.json.gz"


def write_json_lines(records: list[Record], folder: str, at: datetime) -> int:
    """One gzip file of JSON lines under year=/month=/day=/hour= folders."""
    target = os.path.join(folder, object_key(at, len(records)))
    os.makedirs(os.path.dirname(target), exist_ok=True)
    with gzip.open(target, "wt", encoding="utf-8") as f:
        f.writelines(json.dumps(r) + "\n" for r in records)
    return len(records)


def archive(df: DataFrame, path: str, ts: str) -> None:
    """A DataFrame in the same layout, written by the executors."""
    parts = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    dealt = df.withColumns({name: F.date_format(ts, pattern) for name, pattern in parts.items()})
    dealt.write.mode("append").partitionBy(*parts).option("compression", "gzip").json(path)


def split_objects(text: str) -> list[dict]:
    """JSON objects that follow each other with or without line breaks."""
    out, at, decoder = [], 0, json.JSONDecoder()
    while at < len(text):
        if text[at].isspace():
            at += 1
            continue
        found, at = decoder.raw_decode(text, at)
        out.append(found)
    return out
