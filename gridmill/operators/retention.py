"""Retention: expired lake objects and old table partitions."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridmill.functions.columns import quoted
from gridmill.functions.timecols import as_utc, instant
from gridmill.operators.ordered import row_index
from gridmill.session import checkpointed
from gridmill.sources.lake import delete_folder, folders

DELETE_BATCH = 1000
# Delete calls that one task has under way at once.
DELETE_THREADS = 16


def expired_objects(ledger: DataFrame, as_of: datetime, days: int) -> DataFrame:
    """Keys recorded before ``as_of - days``; one row per key."""
    cutoff = as_utc(as_of) - timedelta(days=days)
    return ledger.filter(F.col("processed_at") < instant(cutoff)).select("s3_key").distinct()


def delete_batches(keys: DataFrame, size: int = DELETE_BATCH, splits: int | None = None) -> DataFrame:
    """Number the delete calls: ``size`` keys each, in key order. Ranges of keys are numbered apart and added up."""
    numbered = row_index(keys, ["s3_key"], name="_index", splits=splits)
    return numbered.select("s3_key", F.floor(F.col("_index") / F.lit(size)).cast("long").alias("batch"))


def delete_files(paths: list[str]) -> list[str | None]:
    """Delete objects by URI; the outcome per path is null or an error text."""
    stores: dict[str, object] = {}

    def delete(path: str) -> str | None:
        try:
            root, name = store_uri(path)
            stores[root].delete_file(name)
        except FileNotFoundError:
            return None  # already gone, for example on a repeated task
        except Exception as e:  # noqa: BLE001 - reported per key
            return f"{type(e).__name__}: {e}"
        return None

    from pyarrow import fs

    errors = {}
    for path in paths:
        root, _ = store_uri(path)
        if root not in stores and root not in errors:
            try:
                stores[root] = fs.FileSystem.from_uri(root)[0]
            except Exception as e:  # noqa: BLE001 - reported per key
                errors[root] = f"{type(e).__name__}: {e}"
    with ThreadPoolExecutor(DELETE_THREADS) as pool:
        return list(pool.map(lambda p: errors.get(store_uri(p)[0]) or delete(p), paths))


def store_uri(path: str) -> tuple[str, str]:
    """Root of the store that holds a path, as an Arrow file system names it, and the name within.

    Hadoop's names of object stores (``s3a``, ``s3n``, ``gs``, ``abfss`` ...) and its short ``file:/`` form are understood.
    """
    scheme, _, rest = path.partition(":") if re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*:", path) else ("file", "", path)
    scheme = {"s3a": "s3", "s3n": "s3", "gcs": "gs", "wasbs": "abfss"}.get(scheme, scheme)
    if scheme == "file":
        return "file:///", "/" + rest.lstrip("/")
    host, _, name = rest.removeprefix("//").partition("/")
    if scheme in ("s3", "gs"):
        return f"{scheme}://{host}", f"{host}/{name}"
    return f"{scheme}://{host}/", f"/{name}" if scheme in ("hdfs", "viewfs") else name


def requests(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[str]]]:
    """The keys of one delete call after the other, from rows ordered by call; a call may begin in one batch of rows and end in the next."""
    call, held = None, []
    for part in parts:
        for number, key in zip(part.column("batch").to_pylist(), part.column("s3_key").to_pylist(), strict=True):
            if number != call and held:
                yield call, held
                held = []
            call = number
            held.append(key)
    if held:
        yield call, held


def answered(delete: Callable[[list[str]], list[str | None]], paths: list[str], attempts: int, wait: float) -> list[str | None]:
    """The last answer for every path; what failed is asked for again, and nothing else."""
    errors = list(delete(paths))
    for attempt in range(1, attempts):
        failed = [i for i, e in enumerate(errors) if e is not None]
        if not failed:
            break
        time.sleep(wait * 2 ** (attempt - 1))
        for i, error in zip(failed, delete([paths[i] for i in failed]), strict=True):
            errors[i] = error
    return errors


def purge(keys: DataFrame, size: int = DELETE_BATCH, dry_run: bool = True, prefix: str = "",
          delete: Callable[[list[str]], list[str | None]] = delete_files,
          splits: int | None = None, attempts: int = 3, wait: float = 0.5, tasks: int | None = None) -> DataFrame:
    """Delete expired objects on the executors, ``size`` keys a call; one row per key with the store's answer.

    ``delete`` takes the paths of one call and answers for each: null, or an error text. A store that deletes many objects
    by one request gives its own; the default deletes one by one. Keys that failed are tried ``attempts`` times. The keys
    are computed once, the deletions are done when this returns, and the report can be read again without deleting again.
    ``tasks`` are at most eight a core: calls wait for the store, and tasks take many calls each.
    """
    batches = delete_batches(keys if dry_run else checkpointed(keys), size, splits)
    if dry_run:
        return batches.select("s3_key", "batch", F.lit("expired").alias("status"), F.lit(None).cast("string").alias("error"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for call, names in requests(parts):
            errors = answered(delete, [prefix + k for k in names], attempts, wait)
            yield pa.RecordBatch.from_pydict({
                "s3_key": names, "batch": pa.array([call] * len(names), pa.int64()),
                "status": ["deleted" if e is None else "failed" for e in errors], "error": pa.array(errors, pa.string())})

    numbered = checkpointed(batches)
    calls = (numbered.agg(F.max("batch")).first()[0] or 0) + 1
    most = tasks or 8 * keys.sparkSession.sparkContext.defaultParallelism
    spread = numbered.repartition(min(calls, most), "batch").sortWithinPartitions("batch", "s3_key")
    return checkpointed(spread.mapInArrow(run, "s3_key string, batch long, status string, error string"))


def expire_partitions(df: DataFrame, date_col: str, as_of: datetime, days: int) -> DataFrame:
    """Rows of day partitions that are still kept; rows without a day have no age and stay."""
    first = (as_utc(as_of) - timedelta(days=days)).date()
    return df.filter(quoted(date_col).isNull() | (quoted(date_col) >= F.lit(first)))


def drop_expired_partitions(spark: SparkSession, path: str, date_col: str, as_of: datetime, days: int) -> list[str]:
    """Remove old day folders of a table; returns their names (one per day)."""
    first = (as_utc(as_of) - timedelta(days=days)).date().isoformat()
    days_stored = [n.removeprefix(f"{date_col}=") for n in folders(spark, path) if n.startswith(f"{date_col}=")]
    dropped = sorted(d for d in days_stored if len(d) == 10 and d < first)
    for day in dropped:
        delete_folder(spark, f"{path}/{date_col}={day}")
    return dropped
