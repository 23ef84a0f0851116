"""Raw-file inventory (S11) and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citymotion.sources.common import list_files, open_input
from citymotion.sources.dbase import dbf_summary_of

# fixed values: files skipped by the inventory
SKIP_NAMES = (".gitkeep",)
SKIP_SUFFIX = ".partial"


def list_raw_files(spark: SparkSession, raw_dir: str, dataset: str | None = None) -> DataFrame:
    """Recursive listing (path, length, modificationTime) without ``.gitkeep`` and ``*.partial``;
    no file body is read."""
    root = f"{raw_dir.rstrip('/')}/{dataset}" if dataset else raw_dir
    files = list_files(spark, root, "*", recursive=True)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.where(~name.isin(*SKIP_NAMES) & ~name.endswith(SKIP_SUFFIX)).orderBy("path")


def dbf_summary(path: str) -> dict:
    """Field names and record count of a DBF, from its header only."""
    with open_input(path) as fh:
        return dbf_summary_of(fh.read)


TABULAR_SUFFIXES = (".csv", ".tsv", ".txt")


def preview_zip(spark: SparkSession, path: str, n: int = 5) -> dict:
    """Sample of an archive (S12): header + first ``n`` rows of its first tabular
    member; without one, the first DBF's field names and record count.
    Only the member list, one member's first rows or one DBF header are read."""
    import zipfile

    import pandas as pd

    from citymotion.sources.archives import is_data_member

    with open_input(path) as fh, zipfile.ZipFile(fh) as zf:
        names = zf.namelist()
        tabular = [m for m in names if is_data_member(m, TABULAR_SUFFIXES)]
        if tabular:
            member = tabular[0]
            sep = "\t" if member.lower().endswith(".tsv") else ","
            with zf.open(member) as raw:
                sample = pd.read_csv(raw, sep=sep, dtype=str, nrows=n, keep_default_na=False)
            return {"member": member, "columns": list(sample.columns), "rows": sample.values.tolist()}
        dbfs = [m for m in names if is_data_member(m, (".dbf",))]
        if dbfs:
            with zf.open(dbfs[0]) as raw:
                found = dbf_summary_of(raw.read)
            return {"member": dbfs[0], "columns": found["fields"], "n_records": found["n_records"]}
    return {"member": None, "columns": [], "rows": []}
