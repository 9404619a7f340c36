"""Watermarks kept between runs, for targets that cannot carry their own.

Each save is a new numbered file, so an interrupted save leaves the previous one.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import SparkSession

from tidemark import storage


class SyncState:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def _numbers(self, name: str) -> list[int]:
        files = storage.list_names(self.spark, os.path.join(self.root, name))
        return [int(f[:-5]) for f in files if f.endswith(".json") and f[0] != "."]

    def _file(self, name: str, number: int) -> str:
        return os.path.join(self.root, name, f"{number:08d}.json")

    def load(self, name: str) -> str | None:
        numbers = self._numbers(name)
        if not numbers:
            return None
        saved = json.loads(storage.read_text(self.spark, self._file(name, max(numbers))))
        return None if saved["watermark"] is None else str(saved["watermark"])

    def save(self, name: str, watermark: str | None) -> None:
        number = max(self._numbers(name), default=0) + 1
        storage.publish_text(
            self.spark, self._file(name, number), json.dumps({"watermark": watermark})
        )
