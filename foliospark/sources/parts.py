"""Results that a service gives in parts, as a data source: spark.dataSource.register(Parts), then format("ocr_parts")."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "job string, part int, block_type string, id string, page int, text string, confidence double"


class Part(InputPartition):
    def __init__(self, job: str, nth: int, path: str):
        self.job, self.nth, self.path = job, nth, path


def _load(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def follow(folder: str, job: str, name: str, nth: int = 1) -> list[Part]:
    """The parts of a job from `name` on, each named by the NextToken of the one before; a part that is missing or comes twice is an error."""
    out, seen = [], set()
    while name:
        path = os.path.join(folder, job, f"{name}.json")
        if name in seen:
            raise ValueError(f"part {name} of {job} comes again")
        if not os.path.exists(path):
            raise FileNotFoundError(f"part {name} of {job} is missing")
        seen.add(name)
        out.append(Part(job, nth, path))
        name, nth = _load(path).get("NextToken"), nth + 1
    return out


def blocks(part: Part) -> Iterator[tuple]:
    for b in _load(part.path).get("Blocks") or []:
        yield part.job, part.nth, b.get("BlockType"), b.get("Id"), b.get("Page"), b.get("Text"), None if b.get("Confidence") is None else float(b["Confidence"])


class _Batch(DataSourceReader):
    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[Part]:
        return [p for job in sorted(os.listdir(self.folder)) if os.path.isdir(os.path.join(self.folder, job)) for p in follow(self.folder, job, "first")]

    def read(self, partition: Part) -> Iterator[tuple]:
        return blocks(partition)


class _Stream(DataSourceStreamReader):
    """Offsets are numbers of jobs in order of name: a job is read when all its parts are there, marked by a file `done` in its folder."""

    def __init__(self, folder: str, most: int):
        self.folder, self.most = folder, most

    def _jobs(self) -> list[str]:
        return sorted(j for j in os.listdir(self.folder) if os.path.exists(os.path.join(self.folder, j, "done")))

    def initialOffset(self) -> dict:
        return {"after": ""}

    def latestOffset(self) -> dict:
        jobs = self._jobs()
        return {"after": jobs[-1] if jobs else ""}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        return [p for job in self._jobs() if start["after"] < job <= end["after"] for p in follow(self.folder, job, "first")]

    def read(self, partition: Part) -> Iterator[tuple]:
        return blocks(partition)


class Parts(DataSource):
    """Blocks of OCR jobs: a folder for each job, in it first.json and the parts that NextToken names.

    One partition for each part. Option path: the folder, which all executors must have mounted (the
    parts are opened by Python). As a stream, jobs are taken once they hold a file `done`, in order of
    their names, which must rise with time.
    """

    @classmethod
    def name(cls) -> str:
        return "ocr_parts"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Batch(self.options["path"])

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(self.options["path"], int(self.options.get("most", 0)))
