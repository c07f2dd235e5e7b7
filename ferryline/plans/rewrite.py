"""Update by key in place: only the files that hold a changed key are written again.

1. The keys of the changes are matched with the keys of the directory, read with the name of each
   row's file and without other columns. A semi-join, so Spark sends the changes to all tasks when their
   measured size allows it, and adds a Bloom filter of its own otherwise.
2. The rows of those files are updated and written to a folder that readers skip.
3. A journal that names the new and the old files is put in place by one rename: this is
   the moment of the update, and only one journal can be there. Then the new files are moved in and the
   old ones deleted. A run that ends in between is completed by the next one (``recover``).

All other files keep their names and bytes. Another update that has rewritten one of the same files in the
meantime is noticed, and this one fails without a change. Readers that list files during step 3 may
see a file twice or miss it; let them read when no journal is there.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferryline.errors import TransferError
from ferryline.functions.names import quote_column
from ferryline.operators.update import updated_rows, unique_changes
from ferryline.shared import (
    children, delete_path, exists, make_dir, move_new, read_text, stored, write_text,
)

JOURNAL = "_journal"
_FILE = "_touched_file"


def touched_files(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> list[str]:
    """The files of ``target`` with a row whose key is changed; only key columns are read."""
    named = target.select(*map(quote_column, keys), F.col("_metadata.file_path").alias(_FILE))
    hits = named.join(changes.select(*map(quote_column, keys)), list(keys), "left_semi")
    return sorted(r[0] for r in hits.select(_FILE).distinct().collect())


def update_files(
    spark: SparkSession,
    path: str,
    changes: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    *,
    fmt: str = "parquet",
) -> dict:
    """Update the directory at ``path``, semantics as :func:`update_by_key`.

    Returns how many files were ``touched`` and ``added``. Folders of partition columns
    stay what they are; a row whose partition column is changed moves to the other folder.
    """
    path = path.rstrip("/")
    recover(spark, path)
    target = spark.read.format(fmt).load(path)
    with stored(unique_changes(target, changes, keys, order_by), "changes") as unique:
        old = touched_files(target, unique, keys)
        if not old:
            return {"touched": 0, "added": 0}
        base = path_of(spark, path)
        inside = [_within(base, f) for f in old]
        partitions = [s.split("=", 1)[0] for s in inside[0].split("/")[:-1]]
        staging = f"{path}/_staging-{uuid.uuid4().hex}"
        rows = spark.read.format(fmt).schema(target.schema).option("basePath", path).load(
            [f"{path}/{_escaped(f)}" for f in inside])
        try:
            updated_rows(rows, unique, keys).write.format(fmt).partitionBy(*partitions).save(staging)
            new = _files_below(spark, staging, len(partitions))
            draft = f"{staging}/_draft"
            write_text(spark, draft, json.dumps(
                {"staging": staging.rsplit("/", 1)[1], "new": new, "old": inside}))
            if not move_new(spark, draft, f"{path}/{JOURNAL}"):
                raise TransferError("another update of this directory is under way")
        except Exception:
            delete_path(spark, staging)
            raise
    recover(spark, path)
    if not all(exists(spark, f"{path}/{f}") for f in new):
        raise TransferError("files of this update were rewritten meanwhile; nothing was changed")
    return {"touched": len(old), "added": len(new)}


def recover(spark: SparkSession, path: str) -> bool:
    """Complete an update that has its journal in place; whether there was one.

    An update of files that another one has rewritten before it is taken back instead: no new file has been
    moved yet, and an old one is missing.
    """
    path = path.rstrip("/")
    journal = f"{path}/{JOURNAL}"
    if not exists(spark, journal):
        return False
    plan = json.loads(read_text(spark, journal))
    staging = f"{path}/{plan['staging']}"
    begun = any(exists(spark, f"{path}/{f}") for f in plan["new"])
    if begun or all(exists(spark, f"{path}/{f}") for f in plan["old"]):
        for file in plan["new"]:
            if exists(spark, f"{staging}/{file}"):
                if "/" in file:
                    make_dir(spark, f"{path}/{file.rsplit('/', 1)[0]}")
                move_new(spark, f"{staging}/{file}", f"{path}/{file}")
        for file in plan["old"]:
            delete_path(spark, f"{path}/{file}")
    delete_path(spark, staging)
    delete_path(spark, journal)
    return True


def path_of(spark: SparkSession, path: str) -> str:
    """The path part of a directory as the metadata of its files has it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop_path)
    return full.toUri().getPath().rstrip("/")


def _within(base: str, file: str) -> str:
    """A file of the metadata column, which is percent-encoded, relative to its directory."""
    return unquote(urlparse(file).path).removeprefix(base + "/")


def _escaped(file: str) -> str:
    """A name as a path pattern that means only itself."""
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in file)


def _files_below(spark: SparkSession, folder: str, depth: int) -> list[str]:
    """Data files of a written folder with ``depth`` levels of partition folders, relative to it."""
    names = [n for n in children(spark, folder) if not n.startswith(("_", "."))]
    return names if not depth else [
        f"{name}/{file}" for name in names for file in _files_below(spark, f"{folder}/{name}", depth - 1)]
