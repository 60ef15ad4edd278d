"""Sensor tracks kept as files by case, read through a data source with one partition for each file.

A folder holds ``case_id=<number>/*.parquet`` with columns t, track and value. The reading
processes list and open it with pyarrow, so the path must be a mounted folder or an address
that pyarrow knows (hdfs, s3, gs).
"""

from __future__ import annotations

import json
import posixpath
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pf
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

NAME = "case_tracks"
SCHEMA = "case_id BIGINT, t DOUBLE, track STRING, value DOUBLE"
#: Samples of one file at most; a longer case has several files and so several partitions.
MOST_ROWS = 5_000_000
#: Samples of an Arrow batch.
BATCH_ROWS = 65_536


def write_cases(samples: DataFrame, path: str, parts: int, most_rows: int = MOST_ROWS) -> None:
    """Write (case_id, t, track, value) as a folder of case files.

    Rows are dealt by ranges of (case_id, t), so a case with very many samples is several
    tasks' work and several files. A null case_id names no case; its rows are left out.
    """
    (
        samples.filter("case_id IS NOT NULL").select("case_id", "t", "track", "value")
        .repartitionByRange(parts, "case_id", "t").sortWithinPartitions("case_id", "t")
        .write.partitionBy("case_id").option("maxRecordsPerFile", most_rows).parquet(path)
    )


def _opened(path: str) -> tuple[pf.FileSystem, str]:
    return pf.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pf.LocalFileSystem(), path)


class CaseFile(InputPartition):
    """One file of one case; ``time`` and ``path`` order files by arrival."""

    def __init__(self, path: str, case_id: int, time: int) -> None:
        self.path, self.case_id, self.time = path, case_id, time


def case_files(path: str, cases: Sequence[int] | None = None) -> list[CaseFile]:
    """The files of a folder (of ``cases`` only), in the order of their arrival."""
    system, root = _opened(path)
    found = []
    for info in system.get_file_info(pf.FileSelector(root, recursive=True, allow_not_found=True)):
        folder = posixpath.basename(posixpath.dirname(info.path))
        if info.type == pf.FileType.File and info.path.endswith(".parquet") and folder.startswith("case_id="):
            case_id = folder.removeprefix("case_id=")
            if case_id.lstrip("-").isdigit() and (cases is None or int(case_id) in cases):
                found.append(CaseFile(info.path, int(case_id), info.mtime_ns or 0))
    return sorted(found, key=lambda f: (f.time, f.path))


def _samples(path: str, part: CaseFile, tracks: Sequence[str] | None) -> Iterator[pa.RecordBatch]:
    system, _ = _opened(path)
    chosen = pa.array(tracks, pa.string()) if tracks is not None else None
    with system.open_input_file(part.path) as file:
        for batch in pq.ParquetFile(file).iter_batches(BATCH_ROWS, columns=["t", "track", "value"]):
            if chosen is not None:
                batch = batch.filter(pc.is_in(batch["track"], chosen))
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.case_id] * batch.num_rows, pa.int64()), batch["t"].cast(pa.float64()),
                     batch["track"].cast(pa.string()), batch["value"].cast(pa.float64())],
                    names=["case_id", "t", "track", "value"],
                )


class _Chosen:
    """Options shared by both readers: ``path``, and as JSON lists ``tracks`` and ``cases`` (default all)."""

    def __init__(self, options) -> None:
        self.path = options["path"]
        listed = lambda name: json.loads(options[name]) if name in options else None
        self.tracks, cases = listed("tracks"), listed("cases")
        self.cases = None if cases is None else set(cases)

    def files(self) -> list[CaseFile]:
        return case_files(self.path, self.cases)

    def read(self, partition: CaseFile | None) -> Iterator[pa.RecordBatch]:
        # Spark calls this once with no partition where there is none to read.
        return _samples(self.path, partition, self.tracks) if partition else iter(())


class _Batch(_Chosen, DataSourceReader):
    def partitions(self) -> Sequence[InputPartition]:
        return self.files()


class _Stream(_Chosen, DataSourceStreamReader):
    """Offsets are the arrival (time, path) of the last file taken, so files may come and old ones go.

    A micro-batch takes ``maxFilesPerBatch`` files at most. The source is not told where a
    restarted query stands; therefore each offset is noted under ``progress`` before it is
    handed out, and a restart begins with the noted one, which is never behind the query's.
    """

    def __init__(self, options) -> None:
        super().__init__(options)
        self._most = int(options.get("maxFilesPerBatch", 1_000))
        if self._most < 1:
            raise ValueError("maxFilesPerBatch must be at least 1")
        self._system, folder = _opened(options["progress"])
        self._system.create_dir(folder, recursive=True)
        self._note = posixpath.join(folder, "offset.json")
        self._seen = self._noted()
        self._restarted = self._seen is not None

    def _noted(self) -> dict | None:
        if self._system.get_file_info(self._note).type != pf.FileType.File:
            return None
        with self._system.open_input_stream(self._note) as file:
            return json.loads(file.read())

    def _put(self, offset: dict) -> None:
        # Written whole beside the note, then switched.
        with self._system.open_output_stream(self._note + ".new") as file:
            file.write(json.dumps(offset).encode())
        self._system.move(self._note + ".new", self._note)

    def initialOffset(self) -> dict:
        return {"time": -1, "path": ""}

    def latestOffset(self) -> dict:
        seen = self._seen or self.initialOffset()
        if self._restarted:
            self._restarted = False
            return seen
        waiting = self._between(seen, None)[:self._most]
        if waiting:
            seen = {"time": waiting[-1].time, "path": waiting[-1].path}
            self._put(seen)
        self._seen = seen
        return seen

    def _between(self, start: dict, end: dict | None) -> list[CaseFile]:
        low, high = (None if o is None else (o["time"], o["path"]) for o in (start, end))
        return [f for f in self.files() if low < (f.time, f.path) and (high is None or (f.time, f.path) <= high)]

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return self._between(start, end)


class CaseTracks(DataSource):
    """``spark.read.format("case_tracks")`` and ``spark.readStream.format("case_tracks")``."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Batch(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(self.options)


def _options(tracks: Sequence[str] | None, cases: Sequence[int] | None) -> dict[str, str]:
    return {k: json.dumps(list(v)) for k, v in (("tracks", tracks), ("cases", cases)) if v is not None}


def load_cases(
    spark: SparkSession, path: str, tracks: Sequence[str] | None = None, cases: Sequence[int] | None = None
) -> DataFrame:
    """Samples of the cases in a folder; files of other cases are not opened, other tracks not passed on."""
    spark.dataSource.register(CaseTracks)
    return spark.read.format(NAME).options(**_options(tracks, cases)).load(path)


def replay_cases(
    spark: SparkSession, path: str, progress: str, tracks: Sequence[str] | None = None,
    cases: Sequence[int] | None = None, most_files: int = 1_000,
) -> DataFrame:
    """Samples as case files arrive, ``most_files`` of them in a micro-batch at most.

    ``progress`` is a folder of this query's own, kept as long as its checkpoint. Files
    must be complete when they get their name. A one-off trigger takes one batch of files.
    """
    spark.dataSource.register(CaseTracks)
    return (
        spark.readStream.format(NAME).options(progress=progress, maxFilesPerBatch=most_files, **_options(tracks, cases)).load(path)
    )
