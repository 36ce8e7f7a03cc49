"""A Spark sink that writes one file of a given name for each row, in two phases.

Tasks write under a staging folder of the job, each attempt in a folder of its
own. Only when all have succeeded does the driver move the files of the attempts
that count to their names; if the job fails, it removes the staging folder. So a
failed job leaves no file of a name, and a lost or repeated task none of its own;
a task that ends after its job has failed may leave bytes in the staging folder.

    df.select("file_name", "body").write.format("named_files").option("path", folder).mode("append").save()

A name is a plain file name: not empty, without `/`, not `.` or `..`. A name that
two rows share is an error, and nothing is written. An existing file of the name
is replaced. `overwrite` removes the folder's other files first. Null bodies are
empty files. Only names come to the driver.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from tallyforge.sources.bytefiles import resolve
from tallyforge.sources.folders import ship

STAGING = "_staging-"


@dataclass
class Written(WriterCommitMessage):
    folder: str
    names: list[str]


class NamedFilesWriter(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path.rstrip("/"), overwrite
        self.staging = f"{self.path}/{STAGING}{uuid.uuid4().hex}"

    def write(self, iterator) -> Written:
        system, folder = resolve(f"{self.staging}/{uuid.uuid4().hex}")
        system.create_dir(folder, recursive=True)
        names = set()
        for name, body in iterator:
            if not name or "/" in name or name in (".", "..") or name.startswith(STAGING):
                raise ValueError(f"no name for a file: {name!r}")
            if name in names:
                raise ValueError(f"two rows for the file {name!r}")
            names.add(name)
            with system.open_output_stream(f"{folder}/{name}", compression=None) as out:
                out.write(body.encode() if isinstance(body, str) else bytes(body or b""))
        return Written(folder, sorted(names))

    def commit(self, messages) -> None:
        from pyarrow.fs import FileSelector

        system, target = resolve(self.path)
        names = [n for m in messages if m for n in m.names]
        if len(names) != len(set(names)):
            self.abort(messages)
            raise ValueError("two rows for one file")
        system.create_dir(target, recursive=True)
        if self.overwrite:
            for info in system.get_file_info(FileSelector(target)):
                if info.is_file and info.base_name not in names:
                    system.delete_file(info.path)
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda m: [system.move(f"{m.folder}/{n}", f"{target}/{n}") for n in m.names], [m for m in messages if m]))
        self.abort(messages)

    def abort(self, messages) -> None:
        system, staging = resolve(self.staging)
        if system.get_file_info(staging).type.name == "Directory":
            system.delete_dir(staging)


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "file_name string, body string"

    def writer(self, schema: StructType, overwrite: bool) -> NamedFilesWriter:
        if len(schema) != 2:
            raise ValueError("named_files takes a name and a body")
        return NamedFilesWriter(self.options["path"], overwrite)


def write_named(rows: DataFrame, path: str, name: str = "file_name", body: str = "body", mode: str = "append") -> None:
    """Writes each row's body to the file of its name in the folder `path`."""
    ship(rows.sparkSession)
    rows.sparkSession.dataSource.register(NamedFiles)
    rows.select(name, body).write.format("named_files").option("path", path).mode(mode).save()
