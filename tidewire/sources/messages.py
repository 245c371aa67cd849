"""A message queue as a streaming source: offsets, and a commit that confirms what was handled.

Messages lie as JSON lines in a landing folder, in files whose names sort in order of arrival and that don't change once
they are there.  The offset is the name of the last file read.  Spark asks to commit an offset once the batches up to it
are done; the source then writes it beside the files, so that the sender may delete what is confirmed.  What was read but
not confirmed when a run stops is read again by the next one.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

CONFIRMED = "_confirmed.json"
MESSAGE = "update_id bigint, chat_id bigint, sent_at timestamp, text string"


@dataclass
class _File(InputPartition):
    name: str


class MessageSource(DataSource):
    """``spark.readStream.format("messages").load(folder)``: update_id, chat_id, sent_at (UTC), text.

    ``folder`` is a path or address that pyarrow opens on all machines (file, hdfs, s3).  A line that isn't a JSON object
    with a whole update_id is passed over and confirmed with the rest, so it isn't delivered for ever; other fields that
    don't fit are null.  Option ``files`` (default 100): files a batch at most.
    """

    @classmethod
    def name(cls) -> str:
        return "messages"

    def schema(self) -> str:
        return MESSAGE

    def streamReader(self, schema) -> MessageReader:
        return MessageReader(self.options["path"], int(self.options.get("files", 100)))


class MessageReader(DataSourceStreamReader):
    def __init__(self, path: str, files: int) -> None:
        self.path, self.files, self.last = path, files, None

    def _place(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path) if "://" in self.path else fs.FileSystem.from_uri(f"file://{self.path}") if ":/" not in self.path else fs.FileSystem.from_uri(self.path.replace(":/", ":///", 1))

    def _names(self, after: str, until: str | None = None) -> list[str]:
        place, folder = self._place()
        found = place.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        return sorted(f.base_name for f in found if f.type == fs.FileType.File and f.base_name[0] not in "._" and f.base_name > after and (until is None or f.base_name <= until))

    def initialOffset(self) -> dict:
        return {"after": confirmed(self.path, self._place())}

    def latestOffset(self) -> dict:
        after = self.last if self.last is not None else self.initialOffset()["after"]
        self.last = (self._names(after)[: self.files] or [after])[-1]
        return {"after": self.last}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.last = max(self.last or "", end["after"])
        return [_File(n) for n in self._names(start["after"], end["after"])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        from datetime import UTC, datetime

        place, folder = self._place()
        with place.open_input_stream(f"{folder}/{partition.name}") as f:
            for line in f.read().splitlines():
                try:
                    m = json.loads(line)
                except ValueError:
                    continue
                if not isinstance(m, dict) or type(m.get("update_id")) is not int:
                    continue
                chat, text = m.get("chat_id"), m.get("text")
                try:
                    sent = datetime.fromisoformat(m["sent_at"])
                    sent = sent if sent.tzinfo else sent.replace(tzinfo=UTC)
                except (KeyError, ValueError, TypeError):
                    sent = None
                yield m["update_id"], chat if type(chat) is int else None, sent, text if isinstance(text, str) else None

    def commit(self, end: dict) -> None:
        place, folder = self._place()
        with place.open_output_stream(f"{folder}/{CONFIRMED}.new") as f:
            f.write(json.dumps(end).encode())
        place.move(f"{folder}/{CONFIRMED}.new", f"{folder}/{CONFIRMED}")


def confirmed(path: str, place: tuple[fs.FileSystem, str] | None = None) -> str:
    """The last confirmed file of a landing folder; '' if there is none."""
    system, folder = place or MessageReader(path, 1)._place()
    try:
        with system.open_input_stream(f"{folder}/{CONFIRMED}") as f:
            return json.loads(f.read())["after"]
    except (FileNotFoundError, ValueError, KeyError):
        return ""
