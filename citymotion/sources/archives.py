"""ZIP archives of CSV members (S1, S2) as a Spark data source, and their writer.

``spark.read.format("zip_csv")`` plans one partition per member from each archive's central
directory, so an archive of many members is read by many tasks and a task never sees
another member's bytes.  A member is inflated and parsed as a stream, in bounded chunks;
every row carries ``(path, member, pos)`` — the ingest order keep-last rules rely on.  After
the scan the rows are ordinary DataFrame rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from citymotion.sources.common import list_files, open_input, open_output, paths_of, ship_package
from citymotion.sources.members import is_data_member, locate

__all__ = ["is_data_member", "pack_archives", "read_zip_csv", "year_from_name"]

CHUNK_ROWS = 100_000


@dataclass
class MemberPartition(InputPartition):
    path: str
    member: str


class ZipCsvSource(DataSource):
    """Options (JSON): ``paths``, ``columns``, ``suffixes``, ``sep``, ``limit`` (rows per archive's first member)."""

    @classmethod
    def name(cls) -> str:
        return "zip_csv"

    def schema(self) -> T.StructType:
        own = [T.StructField("path", T.StringType()), T.StructField("member", T.StringType()), T.StructField("pos", T.LongType())]
        return T.StructType(own + [T.StructField(c, T.StringType()) for c in json.loads(self.options["columns"])])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return ZipCsvReader({k: json.loads(self.options[k]) for k in ("paths", "columns", "suffixes", "sep", "limit")})


class ZipCsvReader(DataSourceReader):
    def __init__(self, options: dict):
        self.o = options

    def partitions(self) -> Sequence[InputPartition]:
        out = []
        for path in self.o["paths"]:
            found = locate(path, self.o["suffixes"])
            if not found:
                raise FileNotFoundError(f"No CSV member found in {path}")
            out += [MemberPartition(path, m.name) for m in (found if self.o["limit"] is None else found[:1])]
        return out

    def read(self, partition: MemberPartition) -> Iterator[pa.RecordBatch]:
        import zipfile

        columns, sep, limit = self.o["columns"], self.o["sep"], self.o["limit"]
        schema = pa.schema([("path", pa.string()), ("member", pa.string()), ("pos", pa.int64())] + [(c, pa.string()) for c in columns])
        with open_input(partition.path) as fh, zipfile.ZipFile(fh) as zf, zf.open(partition.member) as raw:
            chunks = pd.read_csv(raw, dtype=str, keep_default_na=False, chunksize=CHUNK_ROWS, sep=sep, engine="python" if sep is None else "c", nrows=limit)
            pos = 0
            for chunk in chunks:
                missing = [c for c in columns if c not in chunk.columns]
                if missing:
                    raise ValueError(f"{partition.path} missing columns: {sorted(missing)}")
                n = len(chunk)
                own = [pa.array([partition.path] * n, pa.string()), pa.array([partition.member] * n, pa.string()), pa.array(range(pos, pos + n), pa.int64())]
                yield pa.RecordBatch.from_arrays(own + [pa.array(chunk[c], pa.string()) for c in columns], schema=schema)
                pos += n


def read_zip_csv(
    spark: SparkSession,
    folder: str,
    glob: str,
    columns: Sequence[str],
    *,
    paths: DataFrame | None = None,
    suffixes: Sequence[str] = (".csv",),
    sep: str | None = ",",
    limit: int | None = None,
) -> DataFrame:
    """Rows of every tabular member of every matching archive, as strings.

    ``columns`` are required; an archive missing one fails with the list.
    ``paths`` (a DataFrame with ``path``) can pre-filter the archive list.
    """
    ship_package(spark)
    spark.dataSource.register(ZipCsvSource)
    options = {"paths": paths_of(paths if paths is not None else list_files(spark, folder, glob)), "columns": list(columns), "suffixes": list(suffixes), "sep": sep, "limit": limit}
    return spark.read.format("zip_csv").options(**{k: json.dumps(v) for k, v in options.items()}).load()


PACK_BYTES = 1 << 20


def pack_archives(files: DataFrame, stored: bool = False) -> DataFrame:
    """Write ZIP archives from ``files`` (archive, path, member): each archive is packed by one
    task, member by member in ``member`` order, streaming ``PACK_BYTES`` at a time.  A repeated
    task writes the same archive again.  Returns (archive, members)."""
    ship_package(files.sparkSession)

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        import zipfile

        archive = group["archive"].iloc[0]
        with open_output(archive) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED if stored else zipfile.ZIP_DEFLATED) as zf:
            for path, member in sorted(zip(group["path"], group["member"]), key=lambda r: r[1]):
                with open_input(path) as fh, zf.open(member, "w") as entry:
                    while part := fh.read(PACK_BYTES):
                        entry.write(part)
        return pd.DataFrame({"archive": [archive], "members": [len(group)]})

    return files.select("archive", "path", "member").groupBy("archive").applyInPandas(pack, "archive string, members long")


def year_from_name(path_col: str = "path") -> F.Column:
    """First dash-separated 4-digit token of the file stem (P1), else NULL."""
    stem = F.regexp_replace(F.regexp_extract(F.col(path_col), r"([^/]+)$", 1), r"\.[^.]*$", "")
    hit = F.regexp_extract(stem, r"(?:^|-)([0-9]{4})(?=-|$)", 1)
    return F.nullif(hit, F.lit("")).cast("int")
