"""Several text outputs written in one pass, all or nothing.

``voxtab_lines`` is a Python data source for writing. Each task stages one
file per output that it has lines for, under a name of its own attempt, and
reports the files in its commit message. Only when all tasks are through does
the driver move the reported files into place, a rename each; files of lost or
repeated attempts go with the staging folder. If a task fails, or the commit
does, what was there before stays as it was.

Defined cases: every output is made, empty ones with an empty file. A null
line is an empty line. A row for an output that is not listed fails the job.
Lines hold no line breaks of their own. Paths are those of a folder that
executors share, or URIs that Arrow can open."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from voxtab.sources.media import _open


@dataclass
class Staged(WriterCommitMessage):
    """The files of one task attempt: (output, name)."""

    files: list[tuple[str, str]]


def _there(store: fs.FileSystem, path: str) -> bool:
    return store.get_file_info(path).type != fs.FileType.NotFound


class LinesWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.root, self.outputs, self.overwrite = options["path"].rstrip("/"), options["outputs"].split(","), overwrite
        self.staging = f"_staging-{uuid.uuid4().hex}"  # one for all tasks: the writer is made once

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        store, root = _open(self.root)
        folder, attempt, streams = f"{root}/{self.staging}", uuid.uuid4().hex, {}
        store.create_dir(folder, recursive=True)
        try:
            for b in iterator:
                for output in b.column(0).unique().to_pylist():
                    if output not in self.outputs:
                        raise ValueError(f"no output {output!r}; have {self.outputs}")
                    if output not in streams:
                        streams[output] = store.open_output_stream(f"{folder}/{output}-{attempt}")
                    lines = b.column(1).filter(pc.equal(b.column(0), output)).fill_null("").to_pylist()
                    streams[output].write("".join(f"{line}\n" for line in lines).encode())
        finally:
            for s in streams.values():
                s.close()
        return Staged([(output, f"{output}-{attempt}") for output in streams])

    def commit(self, messages: list[Staged | None]) -> None:
        store, root = _open(self.root)
        folder = f"{root}/{self.staging}"
        staged = [f for m in messages if m is not None for f in m.files]
        for output in self.outputs:
            store.create_dir(f"{folder}/new/{output}", recursive=True)
        for i, (output, name) in enumerate(staged):
            store.move(f"{folder}/{name}", f"{folder}/new/{output}/part-{i:05d}-{self.staging[-8:]}.txt")
        for output in {*self.outputs} - {output for output, _ in staged}:
            store.open_output_stream(f"{folder}/new/{output}/part-none-{self.staging[-8:]}.txt").close()
        done: list[tuple[str, str]] = []  # moves to take back
        try:
            for output in self.outputs:
                there = _there(store, f"{root}/{output}")
                if there and self.overwrite:
                    self._move(store, f"{root}/{output}", f"{folder}/old-{output}", done)
                if there and not self.overwrite:
                    for info in store.get_file_info(fs.FileSelector(f"{folder}/new/{output}")):
                        self._move(store, info.path, f"{root}/{output}/{info.base_name}", done)
                else:
                    self._move(store, f"{folder}/new/{output}", f"{root}/{output}", done)
        except BaseException:
            for source, target in reversed(done):
                store.move(target, source)
            raise
        store.delete_dir(folder)

    @staticmethod
    def _move(store: fs.FileSystem, source: str, target: str, done: list[tuple[str, str]]) -> None:
        store.move(source, target)
        done.append((source, target))

    def abort(self, messages: list[Staged | None]) -> None:
        store, root = _open(self.root)
        if _there(store, f"{root}/{self.staging}"):
            store.delete_dir(f"{root}/{self.staging}")


class Lines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "voxtab_lines"

    def schema(self) -> str:
        return "output string, value string"

    def writer(self, schema, overwrite: bool) -> LinesWriter:
        return LinesWriter(self.options, overwrite)


def write_lines(rows: DataFrame, path: str, outputs: Sequence[str], mode: str = "overwrite") -> None:
    """Writes ``value`` of each row of ``rows`` (output, value) as a line of
    the folder ``path``/``output``, by one job. ``mode``: ``overwrite`` puts
    each output in the place of an earlier one, ``append`` adds to it."""
    if not outputs or any("," in o or "/" in o for o in outputs):
        raise ValueError(f"outputs must be names without commas and slashes: {list(outputs)}")
    rows.sparkSession.dataSource.register(Lines)
    lines = rows.select(F.col("output").cast("string"), F.col("value").cast("string"))
    lines.write.format("voxtab_lines").mode(mode).option("outputs", ",".join(outputs)).save(path)
