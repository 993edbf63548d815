"""Documents in bulk: batches of bounded size, in place only once all of them are written, and old ones deleted after that.

A Spark data source: each task writes its batches into a folder of its own attempt and tells the driver their names. On
commit the driver moves the batches of the attempts that count into place, and only then what earlier commits have of
the same collection goes. A task that fails, or runs twice, leaves nothing that is read.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..operators.project import q

#: Documents and bytes of a request that a search service takes.
BATCH_DOCUMENTS, BATCH_BYTES = 50, 10 << 20


def batches(documents: Iterator[tuple[str, str]], most: int = BATCH_DOCUMENTS, most_bytes: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Lines of one request after another: an action and a document in turn, within both bounds.

    A single document over the bound is a request of its own.
    """
    held: list[str] = []
    size = 0
    for ident, source in documents:
        lines = [json.dumps({"index": {"_id": ident}}, ensure_ascii=False), source]
        own = sum(len(x.encode()) + 1 for x in lines)
        if held and (len(held) >= 2 * most or size + own > most_bytes):
            yield held
            held, size = [], 0
        held += lines
        size += own
    if held:
        yield held


def file_system(path: str):
    from pyarrow import fs

    local = re.sub(r"^file:/+", "/", path)
    return (fs.LocalFileSystem(), local) if local.startswith("/") else fs.FileSystem.from_uri(path)


@dataclass
class Written(WriterCommitMessage):
    folder: str
    files: list[str] = field(default_factory=list)
    documents: int = 0


class BulkWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.path, self.commit_id = options["path"].rstrip("/"), options.get("commit") or uuid.uuid4().hex
        self.most = int(options.get("documents", BATCH_DOCUMENTS))
        self.most_bytes = int(options.get("bytes", BATCH_BYTES))

    def write(self, iterator: Iterator) -> Written:
        from pyspark import TaskContext

        system, root = file_system(self.path)
        task = TaskContext.get().partitionId()
        out = Written(f"{root}/_attempts/{self.commit_id}/{task}-{uuid.uuid4().hex}")
        system.create_dir(out.folder, recursive=True)
        for n, lines in enumerate(batches(((r["_id"], r["_source"]) for r in iterator), self.most, self.most_bytes)):
            name = f"{self.commit_id}-{task:06d}-{n:06d}.ndjson"
            with system.open_output_stream(f"{out.folder}/{name}") as f:
                f.write("".join(x + "\n" for x in lines).encode())
            out.files.append(name)
            out.documents += len(lines) // 2
        return out

    def commit(self, messages: list) -> None:
        from pyarrow import fs

        system, root = file_system(self.path)
        place = f"{root}/batches/{self.commit_id}"
        system.create_dir(place, recursive=True)
        for m in messages:
            for name in m.files if m else []:
                system.move(f"{m.folder}/{name}", f"{place}/{name}")
        # this file is the commit: a reader takes the folder that it names
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/_new-{self.commit_id}") as f:
            f.write(json.dumps({"commit": self.commit_id, "documents": sum(m.documents for m in messages if m)}).encode())
        system.move(f"{root}/_new-{self.commit_id}", f"{root}/current.json")
        for old in system.get_file_info(fs.FileSelector(f"{root}/batches")):
            if old.base_name != self.commit_id:
                system.delete_dir(old.path)
        self.abort(messages)

    def abort(self, messages: list) -> None:
        from pyarrow import fs

        system, root = file_system(self.path)
        folder = f"{root}/_attempts/{self.commit_id}"
        if system.get_file_info(folder).type != fs.FileType.NotFound:
            system.delete_dir(folder)


class BulkSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bulk_documents"

    def writer(self, schema, overwrite: bool) -> BulkWriter:
        return BulkWriter(self.options)


def write_documents(df: DataFrame, path: str, ident: str, documents: int = BATCH_DOCUMENTS, size: int = BATCH_BYTES) -> None:
    """Writes df's rows as JSON documents, one an id, in batches below path; they take the place of what was there.

    Of repeated ids one row stays, so a batch that is sent again changes nothing. Rows without an id are refused.
    """
    df.sparkSession.dataSource.register(BulkSink)
    rest = [c for c in df.columns if c != ident]
    source = F.to_json(F.struct(*map(q, [ident, *rest])))
    rows = df.select(F.when(q(ident).isNull(), F.raise_error(F.lit(f"{ident} is null"))).otherwise(q(ident).cast("string")).alias("_id"), source.alias("_source"))
    once = rows.groupBy("_id").agg(F.max("_source").alias("_source"))
    once.write.format("bulk_documents").mode("append").option("path", path).option("documents", documents).option("bytes", size).save()


def read_documents(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The documents of the last commit; none before the first."""
    from pyspark.errors import AnalysisException

    try:
        now = spark.read.schema("commit string").json(f"{path.rstrip('/')}/current.json").first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        now = None
    if now is None:
        return spark.createDataFrame([], schema)
    lines = spark.read.text(f"{path.rstrip('/')}/batches/{now['commit']}", recursiveFileLookup=True)
    # actions and documents take turns; an action has nothing but its id
    return lines.where(~F.col("value").startswith('{"index": {"_id": ')).select(F.from_json("value", schema).alias("d")).select("d.*")
