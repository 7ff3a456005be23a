"""The request journal of a live run: an answer is written before anything reads it, so no request is made twice."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillage.sources.scratch import shared_dir

SCHEMA = "original_query_id string, variant_ord int, provider string, search_text string, payload string, error string, asked_at double, answered_at double"


@dataclass(frozen=True)
class Journal:
    """The answers of one run, by (query, variant), as a small file each in a folder that all tasks share.

    Tasks write a file as soon as they have an answer, under another name first, and look for it before they
    ask. So a task that runs again, after its worker or executor was lost, and a run that is started
    again with the same folder, ask only what has no answer. A failure after all attempts is an answer too, until
    ``forget_failures``. Two tasks that ask the same at the same time (speculation) both ask; the first answer stays.
    """

    folder: str

    @staticmethod
    def of(spark: SparkSession, run: str) -> Journal:
        """The journal of a run in the shared folder."""
        return Journal(f"{shared_dir(spark).rstrip('/')}/journal/{run}")

    def _place(self) -> tuple[fs.FileSystem, str]:
        if "://" in self.folder or self.folder.startswith("file:"):
            uri = self.folder if "://" in self.folder else "file://" + self.folder.removeprefix("file:")
            return fs.FileSystem.from_uri(uri)
        return fs.LocalFileSystem(), self.folder

    def _file(self, query: str, variant: int) -> tuple[fs.FileSystem, str, str]:
        store, base = self._place()
        return store, base, f"{base}/{hashlib.sha256(f'{query}/{variant}'.encode()).hexdigest()}.json"

    def held(self, query: str, variant: int) -> dict | None:
        """The record of a request that was answered."""
        store, _, path = self._file(query, variant)
        if store.get_file_info(path).type != fs.FileType.File:
            return None
        with store.open_input_stream(path) as f:
            return json.loads(f.read().decode("utf-8"))

    def record(self, entry: dict) -> dict:
        """Write an answer; gives the one that is kept."""
        store, base, path = self._file(entry["original_query_id"], entry["variant_ord"])
        store.create_dir(base)
        part = f"{base}/.{uuid.uuid4().hex}"
        with store.open_output_stream(part) as f:
            f.write(json.dumps(entry, ensure_ascii=False).encode("utf-8"))
        kept = self.held(entry["original_query_id"], entry["variant_ord"])
        if kept is not None:
            store.delete_file(part)
            return kept
        store.move(part, path)
        return entry

    def answer(self, query: str, variant: int, provider: str, text: str, ask: Callable[[], tuple[str | None, str | None]]) -> dict:
        """The record of a request: the one that is held, or else that of asking now."""
        kept = self.held(query, variant)
        if kept is None:
            began = time.time()
            payload, error = ask()
            kept = self.record({"original_query_id": query, "variant_ord": variant, "provider": provider, "search_text": text, "payload": payload, "error": error, "asked_at": began, "answered_at": time.time()})
        return kept

    def answers(self, spark: SparkSession) -> DataFrame:
        """Every record; none if nothing was asked."""
        store, base = self._place()
        store.create_dir(base)
        return spark.read.schema(SCHEMA).json(self.folder)

    def last(self, spark: SparkSession) -> float:
        """When the last answer came, in seconds since 1970; 0 for none."""
        return self.answers(spark).agg(F.max("answered_at")).first()[0] or 0.0

    def forget_failures(self, spark: SparkSession) -> int:
        """Delete the records of requests that failed, so that a run that goes on asks them again; how many there were."""
        failed = self.answers(spark).where("error is not null").select("original_query_id", "variant_ord").collect()
        for r in failed:
            store, _, path = self._file(r["original_query_id"], r["variant_ord"])
            store.delete_file(path)
        return len(failed)
