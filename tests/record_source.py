"""A partitioned source of records with offsets, for tests: what a topic is to Spark, read
from files.  A folder holds ``<partition>.jsonl``, one JSON record a line; a record's
offset is its line number.  Streams start at the earliest record and remember, in their
checkpoint, the next offset of every partition."""

import json
import os
from datetime import datetime, timezone

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "key string, value string, partition int, offset long, timestamp timestamp"


def append(folder, partition, records):
    """Add (key, value, seconds) records to a partition."""
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{partition}.jsonl", "a", encoding="utf-8") as f:
        for key, value, seconds in records:
            f.write(json.dumps({"key": key, "value": value, "time": seconds}) + "\n")


def lines(folder, partition):
    with open(f"{folder}/{partition}.jsonl", encoding="utf-8") as f:
        return f.readlines()


class Range(InputPartition):
    def __init__(self, partition, start, end):
        self.partition, self.start, self.end = partition, start, end


class RecordReader(DataSourceStreamReader):
    def __init__(self, folder):
        self.folder = folder

    def initialOffset(self):
        return {}

    def latestOffset(self):
        names = sorted(n for n in os.listdir(self.folder) if n.endswith(".jsonl"))
        return {n[:-6]: len(lines(self.folder, n[:-6])) for n in names}

    def partitions(self, start, end):
        return [Range(p, start.get(p, 0), n) for p, n in end.items() if n > start.get(p, 0)]

    def read(self, part):
        for offset, line in enumerate(lines(self.folder, part.partition)[part.start:part.end], part.start):
            r = json.loads(line)
            yield (r["key"], r["value"], int(part.partition), offset, datetime.fromtimestamp(r["time"], timezone.utc))

    def commit(self, end):
        pass


class RecordSource(DataSource):
    @classmethod
    def name(cls):
        return "test_records"

    def schema(self):
        return SCHEMA

    def streamReader(self, schema):
        return RecordReader(self.options["path"])
