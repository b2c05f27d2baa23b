"""Run folders as a data source: plan logs named by case, pass, run and variant, each a file of its own or many packed in archives.

``spark.read.format("plan_logs").load(root)`` and ``df.write.format("plan_logs").mode("append").save(root)`` after
:func:`register`. Paths are those of pyarrow's file systems: a folder all executors share, or an object store it knows.
"""

from __future__ import annotations

import io
import tarfile
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import chain

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from mendwork.sources.logs import PLAN_PATTERN

FORMAT = "plan_logs"
SCHEMA = "case_id string, pass int, run_index int, variant string, path string, plan string"
# fixed value: where a plan log lies under its run folder
PLAN_FILE = "raw/{case}/pass_{turn:03d}/run_{run}/{variant}/explain.json"
# Cases that one task lists and reads.
CASES_PER_TASK = 64
STAGING = "_staging"
# Packed logs lie here, in tar archives of about so many logs or bytes of text, whichever is reached first.
PACKS = "packs"
PACK_LOGS = 10_000
PACK_BYTES = 32 << 20


def _opened(root: str) -> tuple[fs.FileSystem, str]:
    store, path = fs.FileSystem.from_uri(root) if ":" in root.split("/")[0] else (fs.LocalFileSystem(), root)
    return store, path.rstrip("/")


def plan_file(case: str, turn: int, run: int, variant: str) -> str:
    """The relative path of a plan log; the names must be usable as names of folders."""
    for name in (case, variant):
        if not name or "/" in name or name in (".", ".."):
            raise ValueError(f"{name!r} cannot name a folder")
    return PLAN_FILE.format(case=case, turn=turn, run=run, variant=variant)


@dataclass
class Cases(InputPartition):
    names: list[str]


@dataclass
class Pack(InputPartition):
    path: str


@dataclass
class Staged(WriterCommitMessage):
    """What one task has staged: its folder, and the files in it by their final relative paths."""

    folder: str
    files: list[str] = field(default_factory=list)


class PlanLogReader(DataSourceReader):
    """The driver lists the case folders and the archives; each task lists and reads the trees of its cases, or reads one archive."""

    def __init__(self, root: str):
        self.root = root

    def partitions(self) -> list[InputPartition]:
        store, root = _opened(self.root)
        found = store.get_file_info(fs.FileSelector(f"{root}/raw", allow_not_found=True))
        names = sorted(f.base_name for f in found if f.type == fs.FileType.Directory)
        packs = store.get_file_info(fs.FileSelector(f"{root}/{PACKS}", allow_not_found=True))
        cases = [Cases(names[i : i + CASES_PER_TASK]) for i in range(0, len(names), CASES_PER_TASK)]
        return [*cases, *[Pack(path) for path in sorted(f.path for f in packs if f.type == fs.FileType.File)]] or [Cases([])]

    def _packed(self, path: str) -> Iterator[tuple]:
        store, _ = _opened(self.root)
        with store.open_input_stream(path, compression=None) as file, tarfile.open(fileobj=file, mode="r|gz") as pack:
            for member in pack:
                known = PLAN_PATTERN.search(f"/{member.name}")
                if known:
                    case_id, turn, run, variant = known.groups()
                    yield case_id, int(turn), int(run), variant, f"{path}/{member.name}", pack.extractfile(member).read().decode("utf-8")

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if isinstance(partition, Pack):
            yield from self._packed(partition.path)
            return
        store, root = _opened(self.root)
        for case in partition.names:
            for info in sorted(store.get_file_info(fs.FileSelector(f"{root}/raw/{case}", recursive=True)), key=lambda f: f.path):
                known = PLAN_PATTERN.search(f"/{info.path.removeprefix(root).lstrip('/')}") if info.type == fs.FileType.File else None
                if known:
                    with store.open_input_stream(info.path) as file:
                        text = file.read().decode("utf-8")
                    case_id, turn, run, variant = known.groups()
                    yield case_id, int(turn), int(run), variant, info.path, text


class PlanLogWriter(DataSourceWriter):
    """Tasks stage their files; only when all tasks have ended are they moved to their names.

    A task that fails or is repeated leaves its staged files to :meth:`abort` or :meth:`commit`, which drop the whole
    staging folder of the write. A repeated move finds the same content under the name.
    """

    def __init__(self, root: str, columns: list[str], packed: bool = False):
        self.root, self.columns, self.packed, self.job = root, columns, packed, uuid.uuid4().hex

    def write(self, iterator: Iterator) -> Staged:
        store, root = _opened(self.root)
        staged = Staged(f"{STAGING}/{self.job}/{uuid.uuid4().hex}")
        case, turn, run, variant, plan = (self.columns.index(c) for c in ("case_id", "pass", "run_index", "variant", "plan"))
        logs = (
            (plan_file(row[case], row[turn], row[run], row[variant]), row[plan].encode("utf-8")) for row in iterator if row[plan] is not None
        )
        if self.packed:
            staged.files += self._pack(store, f"{root}/{staged.folder}", logs)
            return staged
        for name, text in logs:
            target = f"{root}/{staged.folder}/{name}"
            store.create_dir(target.rsplit("/", 1)[0], recursive=True)
            with store.open_output_stream(target) as file:
                file.write(text)
            staged.files.append(name)
        return staged

    def _pack(self, store: fs.FileSystem, folder: str, logs: Iterator[tuple[str, bytes]]) -> Iterator[str]:
        """Writes archive after archive, each until it is full, and names them."""
        for first in logs:
            name, n_logs, n_bytes = f"{PACKS}/{uuid.uuid4().hex}.tar.gz", 0, 0
            store.create_dir(f"{folder}/{PACKS}", recursive=True)
            with (
                store.open_output_stream(f"{folder}/{name}", compression=None) as file,
                tarfile.open(fileobj=file, mode="w|gz", compresslevel=3) as pack,
            ):
                for log, text in chain([first], logs):
                    member = tarfile.TarInfo(log)
                    member.size = len(text)
                    pack.addfile(member, io.BytesIO(text))
                    n_logs, n_bytes = n_logs + 1, n_bytes + len(text)
                    if n_logs >= PACK_LOGS or n_bytes >= PACK_BYTES:
                        break
            yield name

    def commit(self, messages: list[Staged | None]) -> None:
        store, root = _opened(self.root)

        def publish(place: tuple[str, str]) -> None:
            folder, name = place
            store.create_dir(f"{root}/{name}".rsplit("/", 1)[0], recursive=True)
            store.move(f"{root}/{folder}/{name}", f"{root}/{name}")

        with ThreadPoolExecutor(16) as pool:
            list(pool.map(publish, [(m.folder, name) for m in messages if m is not None for name in m.files]))
        self._clear(store, root)

    def abort(self, messages: list[Staged | None]) -> None:
        self._clear(*_opened(self.root))

    def _clear(self, store: fs.FileSystem, root: str) -> None:
        folder = f"{root}/{STAGING}/{self.job}"
        if store.get_file_info(folder).type == fs.FileType.Directory:
            store.delete_dir(folder)


class PlanLogSource(DataSource):
    """``plan_logs``: reads and writes ``raw/<case>/pass_001/run_1/<variant>/explain.json`` under a root, or with the option
    ``packed`` under these names in archives."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> PlanLogReader:
        return PlanLogReader(self.options["path"])

    def writer(self, schema: StructType, overwrite: bool) -> PlanLogWriter:
        if overwrite:
            raise ValueError("plan logs are added to a run folder, not overwritten")
        return PlanLogWriter(self.options["path"], schema.names, self.options.get("packed", "false") == "true")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(PlanLogSource)


def write_plan_logs(plans: DataFrame, root: str, packed: bool = False) -> None:
    """Writes ``plan`` of each row (``case_id``, ``pass``, ``run_index``, ``variant``) as a file of its own; null plans leave no file.

    Rows of one name write the same file, the last one moved stays. Nothing shows under ``raw`` before all tasks have ended.
    A file and its three folders take 16 KB of most disks, however short the plan; ``packed`` writes the same files as members of
    gzipped tar archives instead, which grow with the text. Their names must differ: a repeated one is read as often.
    """
    register(plans.sparkSession)
    named = plans.selectExpr("cast(case_id AS string) case_id", "cast(pass AS int) pass", "cast(run_index AS int) run_index", "variant", "cast(null AS string) path", "plan")
    named.write.format(FORMAT).mode("append").option("packed", str(packed).lower()).save(root)


def read_plan_logs(spark: SparkSession, root: str) -> DataFrame:
    """case_id, pass, run_index, variant, path, plan of all plan logs of a run folder, in files and in archives."""
    register(spark)
    return spark.read.format(FORMAT).load(root)
