"""Delivery of payloads to destinations as a Spark sink, once for each destination and key.

    delivery.send(rows, "package.module:function", ledger)

rows are (destination, address, key, payload); the payload is made in the JVM (sinks.PAYLOADS). The function takes the four and returns whether the destination took them. Before a row is sent its mark is looked up in the ledger, a
folder that all executors reach, and after it was taken the mark is written. A destination that fails does not keep others from being sent: the write fails at its end, naming what is left, and can be started again,
when marked rows are passed over. A row can be sent twice only if a task dies between the destination's answer and the mark. The commit, which is written last, lists what was sent and what had been before.
"""

from __future__ import annotations

import hashlib
import importlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from . import sinks

SCHEMA = "destination string, address string, key string, payload string"


class Undelivered(RuntimeError):
    """Some destinations did not take what they were sent."""


@dataclass
class Sent(WriterCommitMessage):
    sent: list
    before: list
    failed: list


class Ledger:
    """Marks of what was taken, a file each."""

    def __init__(self, folder: str):
        from pyarrow.fs import FileSystem

        self.fs, self.path = FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        self.fs.create_dir(self.path, recursive=True)

    def _file(self, destination: str, key: str) -> str:
        return f"{self.path}/{hashlib.sha256(json.dumps([destination, key]).encode()).hexdigest()}.sent"

    def has(self, destination: str, key: str) -> bool:
        from pyarrow.fs import FileType

        return self.fs.get_file_info(self._file(destination, key)).type == FileType.File

    def put(self, destination: str, key: str) -> None:
        self.write(self._file(destination, key), {"destination": destination, "key": key})

    def write(self, path: str, value) -> None:
        with self.fs.open_output_stream(path) as f:
            f.write(json.dumps(value).encode())


def _function(name: str):
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


class Deliveries(DataSource):
    """Options: send (module:function), ledger (folder)."""

    @classmethod
    def name(cls) -> str:
        return "deliveries"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["send"], self.options["ledger"])


class _Writer(DataSourceWriter):
    def __init__(self, send: str, ledger: str):
        self.send, self.ledger = send, ledger

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        send, ledger, out = _function(self.send), Ledger(self.ledger), Sent([], [], [])
        for row in iterator:
            name = (row["destination"], row["key"])
            if ledger.has(*name):
                out.before.append(name)
                continue
            try:
                taken = bool(send(row["destination"], row["address"], row["key"], row["payload"]))
            except Exception:  # a sender may fail in any way, and others are still to be sent
                taken = False
            if taken:
                ledger.put(*name)
            (out.sent if taken else out.failed).append(name)
        return out

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        done = [m for m in messages if m is not None]
        every = {part: sorted(tuple(x) for m in done for x in getattr(m, part)) for part in ("sent", "before", "failed")}
        ledger = Ledger(self.ledger)
        if every["failed"]:
            ledger.write(f"{ledger.path}/_failed", every)
            raise Undelivered(f"not taken: {every['failed'][:20]}")
        ledger.write(f"{ledger.path}/_commit", every)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """Marks stay, since what was taken cannot be called back; nothing says that all was sent."""
        ledger = Ledger(self.ledger)
        ledger.write(f"{ledger.path}/_aborted", {"sent": sorted(tuple(x) for m in messages if m is not None for x in m.sent)})


def addressed(digests: DataFrame, targets: dict[str, str], title: str, key: str = "key", text: str = "text") -> DataFrame:
    """(destination, address, key, payload) of digests (key, text) for each target, with the payload that the service takes. A bridge takes what a webhook takes, a file the text as it is."""
    payload: Column = F.col(text)
    for name in targets:
        if name != "file":
            made = sinks.PAYLOADS.get(name, sinks.webhook_payload)(F.col(text), title)
            payload = F.when(F.col("destination") == name, made).otherwise(payload)
    listed = F.array(*[F.struct(F.lit(n).alias("destination"), F.lit(a).alias("address")) for n, a in targets.items()])
    return digests.select(F.col(key).cast("string").alias("key"), F.col(text), F.explode(listed).alias("t")).select("key", text, "t.*").select("destination", "address", "key", payload.alias("payload"))


def send(rows: DataFrame, function: str, ledger: str) -> None:
    """Sends each row once. A destination and key go to one task, and one row of them counts."""
    rows.sparkSession.dataSource.register(Deliveries)
    once = rows.dropDuplicates(["destination", "key"])
    once.select("destination", "address", "key", "payload").write.format("deliveries").option("send", function).option("ledger", ledger).mode("append").save()
