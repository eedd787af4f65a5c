"""Polling of the vehicle-position interface: a client with an injectable transport, one poll as an
ingestion step, and a data source for Spark."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

from fleetmill import schemas
from fleetmill.config import DEFAULT, Settings
from fleetmill.sources.messages import MessageWriter, Record, write_json_lines

#: (method, path, cookie) -> (status, body, cookie to keep)
Transport = Callable[[str, str, str | None], tuple[int, str, str | None]]


class PollError(RuntimeError):
    pass


@dataclass
class PositionClient:
    """Signs in once, keeps the cookie, and signs in again once if it is refused."""

    transport: Transport
    token: str
    cookie: str | None = field(default=None, repr=False)

    def sign_in(self) -> None:
        status, body, cookie = self.transport("POST", f"/Login/Autenticar?token={self.token}", None)
        if status != 200 or body.strip().lower() != "true":
            raise PollError("the interface refused to sign in")
        self.cookie = cookie

    def positions(self) -> dict:
        if self.cookie is None:
            self.sign_in()
        status, body, _ = self.transport("GET", "/Posicao", self.cookie)
        if status == 401:
            self.sign_in()
            status, body, _ = self.transport("GET", "/Posicao", self.cookie)
        if status != 200:
            raise PollError(f"the interface answered {status}")
        return json.loads(body)


def flatten(response: dict, ingested: str) -> list[Record]:
    """One record for each vehicle, as silver.flatten_positions has it for DataFrames."""
    out = []
    for line in response.get("l") or []:
        head = {"line_code": line.get("cl"), "line_number": line.get("c"), "line_direction": line.get("sl")}
        for v in line.get("vs") or []:
            place = {"latitude": v.get("py"), "longitude": v.get("px"), "is_accessible": v.get("a"), "event_timestamp": v.get("ta")}
            out.append({"vehicle_id": str(v["p"]), **head, **place, "ingestion_timestamp": ingested})
    return out


def ingest_once(client: PositionClient, writer: MessageWriter | str, cfg: Settings = DEFAULT, now: datetime | None = None) -> dict:
    """One poll: fetch, flatten, write to the message stream (a writer) or as gzip JSON lines under
    a folder (a path); a summary with the status an HTTP handler would give."""
    now = now or datetime.now(timezone.utc)
    try:
        response = client.positions()
    except Exception as e:  # reported, so that the scheduler's next poll goes on
        return {"status": 500, "error": str(e), "written": 0}
    records = flatten(response, now.isoformat())
    written = 0
    if records:
        written = write_json_lines(records, writer, now) if isinstance(writer, str) else writer.write(records)
    mode = "files" if isinstance(writer, str) else "stream"
    return {"status": 200, "written": written, "total": len(records), "lines": len(response.get("l") or []), "time": response.get("hr"), "mode": mode}


class PositionSource(DataSource):
    """``format("vehicle_positions")``: the option ``fetch`` names a function, ``module:function``,
    that returns one response; each read, or each batch of a stream, is one poll."""

    @classmethod
    def name(cls) -> str:
        return "vehicle_positions"

    def schema(self) -> str:
        return schemas.RAW_POSITIONS

    def _poll(self) -> list[tuple]:
        import importlib

        module, _, function = self.options["fetch"].partition(":")
        records = flatten(getattr(importlib.import_module(module), function)(), datetime.now(timezone.utc).isoformat())
        return [tuple(r[c.split()[0]] for c in schemas.RAW_POSITIONS.split(", ")) for r in records]

    def reader(self, schema) -> DataSourceReader:
        source = self

        class Reader(DataSourceReader):
            def read(self, partition: InputPartition) -> Iterator[tuple]:
                yield from source._poll()

        return Reader()

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        source = self

        class Reader(SimpleDataSourceStreamReader):
            def initialOffset(self) -> dict:
                return {"poll": 0}

            def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
                return iter(source._poll()), {"poll": start["poll"] + 1}

            def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
                return iter(())  # a poll can't be repeated: what was lost before it was written stays lost

        return Reader()
