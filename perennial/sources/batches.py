"""Tables that lie in ``batch=`` folders, one for each written batch, and their compaction.

A batch written again under its name replaces itself. Small batches add up, so
``compact`` merges finished ones into one batch and records that in a manifest:
a merged batch counts only once the manifest names it, and from then on the
batches it replaced do not. Readers need the manifest's names only, and a lost
driver leaves either the old batches or the merged one in force.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_MERGED = "merged-"
_MANIFEST = "_manifest"
# Newest batches of a stream that stay apart: the last one may yet be written again.
NEWEST = 2


def _store(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _matched(spark: SparkSession, pattern: str) -> list[str]:
    store, place = _store(spark, pattern)
    return [status.getPath().toString() for status in store.globStatus(place) or ()]


def number(batch: Column) -> Column:
    """The order of batches: the number their name ends with."""
    return F.regexp_extract(batch, r"(\d+)$", 1).cast("long")


_NONE = {"serial": 0, "merged": [], "replaced": []}


def _manifest(spark: SparkSession, path: str) -> dict | None:
    """The newest manifest; a table that no compaction has begun on has none."""
    found = _matched(spark, f"{path}/{_MANIFEST}/*.json")
    if not found:
        return None
    newest = max(found, key=lambda p: int(re.search(r"(\d+)\.json$", p).group(1)))
    return json.loads(spark.read.text(newest, wholetext=True).first()[0])


def live(spark: SparkSession, path: str) -> Column:
    """Which rows count, as a condition on ``batch`` that leaves whole folders unread."""
    manifest = _manifest(spark, path)
    if manifest is None:
        return F.lit(True)
    merged = F.startswith(F.col("batch"), F.lit(_MERGED))
    kept = ~merged | F.col("batch").isin(manifest["merged"])
    return kept & ~F.col("batch").isin(manifest["replaced"]) if manifest["replaced"] else kept


def names(spark: SparkSession, path: str, depth: int = 0) -> list[str]:
    """Names of the batches in force; ``depth`` folders lie above the batches."""
    manifest = _manifest(spark, path) or _NONE
    found = {p.rsplit("/batch=", 1)[1] for p in _matched(spark, path + "/*" * depth + "/batch=*")}
    return sorted(
        b for b in found if b not in manifest["replaced"] and (not b.startswith(_MERGED) or b in manifest["merged"])
    )


def drop(spark: SparkSession, path: str, names_: list[str]) -> None:
    """Delete batches that are not needed any more."""
    store, _ = _store(spark, path)
    for name in names_:
        store.delete(_store(spark, f"{path}/batch={name}")[1], True)


def _order(name: str) -> int:
    found = re.search(r"\d+$", name)
    return int(found.group()) if found else 0


def _finished(names_: list[str], newest: int) -> list[str]:
    """Names that no writer comes back to: merged ones, and of each stream all but the newest."""
    streams: dict[str, list[str]] = {}
    for name in names_:
        streams.setdefault(_MERGED if name.startswith(_MERGED) else re.sub(r"\d+$", "", name), []).append(name)
    out = streams.pop(_MERGED, [])
    for members in streams.values():
        out += sorted(members, key=_order)[: max(0, len(members) - newest)]
    return out


def compact(
    spark: SparkSession,
    path: str,
    read: Callable[[], DataFrame],
    by: tuple[str, ...] = (),
    merge: Callable[[DataFrame], DataFrame] | None = None,
    newest: int = NEWEST,
) -> int:
    """Merge all but each stream's newest batches into one; returns how many it replaced.

    ``read`` gives the live rows with their ``batch``, ``by`` are the partition
    columns above the batches, ``merge`` may drop rows that newer ones
    supersede. One compaction of a table runs at a time. What the compaction
    before has replaced is deleted now, so readers that began earlier are done.
    """
    manifest = _manifest(spark, path)
    if manifest is None:
        # from now on merged batches count by manifest only
        manifest = _NONE
        _commit(spark, path, manifest)
    store, _ = _store(spark, path)
    for name in manifest["replaced"]:
        for folder in _matched(spark, path + "/*" * len(by) + f"/batch={name}"):
            store.delete(_store(spark, folder)[1], True)
    finished = _finished(names(spark, path, len(by)), newest)
    if len(finished) < 2:
        return 0
    serial = manifest["serial"] + 1
    merged_name = f"{_MERGED}{serial}-{max(map(_order, finished))}"
    rows = read().where(F.col("batch").isin(finished))
    rows = merge(rows) if merge else rows
    (
        rows.withColumn("batch", F.lit(merged_name))
        .hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by, "batch")
        .parquet(path)
    )
    _commit(spark, path, {"serial": serial, "merged": [merged_name], "replaced": finished})
    return len(finished)


def _commit(spark: SparkSession, path: str, manifest: dict) -> None:
    """Put a manifest in place by one rename; those before the last are deleted."""
    folder = f"{path}/{_MANIFEST}"
    store, hidden = _store(spark, f"{folder}/.{manifest['serial']}.part")
    out = store.create(hidden, True)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    if not store.rename(hidden, _store(spark, f"{folder}/{manifest['serial']}.json")[1]):
        raise OSError(f"manifest {manifest['serial']} of {path} could not be put in place")
    for old in range(manifest["serial"] - 2, max(0, manifest["serial"] - 5), -1):
        store.delete(_store(spark, f"{folder}/{old}.json")[1], False)
