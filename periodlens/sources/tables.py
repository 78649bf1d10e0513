"""Run-partitioned staging tables, versioned tables, manifest and sinks."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: File of a version that lists what it consists of, and the column that buckets are kept by.
_LIST = "parts.json"
BUCKET = "_bucket"


def replace_run(df: DataFrame, path: str) -> None:
    """Write one run's rows; a repeated run replaces its own rows only."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )


def run_changes(staged: DataFrame, before: str, after: str) -> DataFrame:
    """``source_record_id`` and ``change`` for each record of two runs: ``added``, ``removed``, ``changed`` or ``same``.

    Records are compared by their stored fingerprints. One aggregation over
    ids and fingerprints of the two runs: other columns and runs are not read.
    """
    of = lambda run: F.max(F.when(F.col("run_id") == run, F.col("row_hash")))
    both = (
        staged.where(F.col("run_id").isin(before, after))
        .groupBy("source_record_id")
        .agg(of(before).alias("_before"), of(after).alias("_after"))
    )
    change = (
        F.when(F.col("_before").isNull(), "added")
        .when(F.col("_after").isNull(), "removed")
        .when(F.col("_before") == F.col("_after"), "same")
        .otherwise("changed")
    )
    return both.select("source_record_id", change.alias("change"))


def latest_run(staged: DataFrame) -> str:
    """Run id of the newest staged row."""
    found = staged.agg(F.max_by("run_id", "ingested_at")).first()[0]
    if found is None:
        raise ValueError("no staged runs")
    return found


def _versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the completely written versions under ``root``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/version-*/_SUCCESS")) or []
    return sorted(int(status.getPath().getParent().getName().removeprefix("version-")) for status in done)


def write_version(df: DataFrame, root: str, check: Callable[[DataFrame], None] | None = None) -> int:
    """Write ``df`` as the next version; readers keep the one they opened.

    The rows are written aside, ``check`` reads them there and may raise, and
    only then they become a version: after a failure the old one stays current.
    Two writers of one version cannot both succeed.
    """
    spark = df.sparkSession
    number = (_versions(spark, root) or [0])[-1] + 1
    aside, final = f"{root}/pending-{uuid.uuid4().hex}", f"{root}/version-{number:06d}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    files = hadoop(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        df.write.parquet(aside)
        if check is not None:
            check(spark.read.schema(df.schema).parquet(aside))
        if files.exists(hadoop(final)) or not files.rename(hadoop(aside), hadoop(final)):
            raise RuntimeError(f"{final} was written by another run")
    except Exception:
        files.delete(hadoop(aside), True)
        raise
    return number


def _list_of(spark: SparkSession, root: str, number: int) -> dict:
    """What a version consists of: ``folders`` under ``root``, ``schema``, and for a bucketed table ``keys`` and ``buckets``."""
    folder = f"{root}/version-{number:06d}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    files = hadoop(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(hadoop(f"{folder}/{_LIST}")):
        schema = spark.read.parquet(folder).schema
        return {"folders": [f"version-{number:06d}"], "schema": schema.json(), "keys": None, "buckets": None}
    return json.loads("".join(row.value for row in spark.read.text(f"{folder}/{_LIST}").collect()))


def _write_list(spark: SparkSession, root: str, number: int, content: dict) -> None:
    """Make ``content`` version ``number``; it appears whole or not at all."""
    aside, final = f"{root}/pending-{uuid.uuid4().hex}", f"{root}/version-{number:06d}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    files = hadoop(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name, text in ((_LIST, json.dumps(content)), ("_SUCCESS", "")):
        out = files.create(hadoop(f"{aside}/{name}"))
        out.write(bytearray(text.encode()))
        out.close()
    if files.exists(hadoop(final)) or not files.rename(hadoop(aside), hadoop(final)):
        files.delete(hadoop(aside), True)
        raise RuntimeError(f"{final} was written by another run")


def _read_folders(spark: SparkSession, root: str, folders: list[str], schema: T.StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{folder}" for folder in folders])


def _new_part(
    df: DataFrame, root: str, check: Callable[[DataFrame], None] | None, buckets: int | None = None
) -> tuple[str, int]:
    """Write ``df`` as a part that no version names yet, and count its rows; ``check`` may refuse it."""
    spark, name = df.sparkSession, f"part-{uuid.uuid4().hex}"
    counted = Observation(f"rows-{name}")
    rows = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.partitionBy(BUCKET) if buckets else rows.write
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    files = hadoop(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        writer.parquet(f"{root}/{name}")
        if check is not None:
            check(spark.read.schema(df.schema).parquet(f"{root}/{name}").drop(BUCKET))
    except Exception:
        files.delete(hadoop(f"{root}/{name}"), True)
        raise
    return name, counted.get["rows"]


def append_version(rows: DataFrame, root: str, check: Callable[[DataFrame], None] | None = None) -> int:
    """Add ``rows`` to the table as one more part; returns how many there are.

    Nothing written before is read or copied: the new version lists the parts
    of the last one and the new one. ``check`` sees the new rows. Without rows
    there is no new version.
    """
    spark = rows.sparkSession
    known = _versions(spark, root)
    name, count = _new_part(rows, root, check)
    if not count and known:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        hadoop(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop(f"{root}/{name}"), True)
        return 0
    last = _list_of(spark, root, known[-1]) if known else {"folders": [], "schema": rows.schema.json()}
    if last.get("buckets"):
        raise ValueError(f"{root} is bucketed; use upsert_version")
    content = {"folders": [*last["folders"], name], "schema": last["schema"], "keys": None, "buckets": None}
    _write_list(spark, root, (known or [0])[-1] + 1, content)
    return count


def bucket_of(keys: Iterable[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def upsert_version(
    rows: DataFrame,
    root: str,
    keys: list[str],
    merge: Callable[[DataFrame, DataFrame, int], DataFrame],
    schema: T.StructType | str,
    surrogate: str | None = None,
    check: Callable[[DataFrame], None] | None = None,
    buckets: int = 64,
    notes: dict | None = None,
    whole: bool = False,
) -> list[int]:
    """Merge ``rows`` into a table that is kept in buckets by ``keys``; returns the buckets that were written.

    Only the buckets that ``rows`` fall into are read and written anew, through
    ``merge(old rows, new rows, highest surrogate)``; the new version names the
    old folders of all others. ``rows`` is read twice, so it should be stored.
    The number of buckets is fixed when the table begins: about its size in
    bytes / 128 MB. ``notes`` are kept with the version (``version_notes``).
    With ``whole`` the rows replace the table, which begins anew.
    """
    spark = rows.sparkSession
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    known = _versions(spark, root)
    anew = whole or not known
    last = {"folders": [], "buckets": buckets, "keys": keys} if anew else _list_of(spark, root, known[-1])
    if last["keys"] != keys:
        raise ValueError(f"{root} is not bucketed by {keys}")
    bucket = bucket_of(keys, last["buckets"])
    touched = sorted(row[0] for row in rows.select(bucket).distinct().collect())
    if not touched and not whole:
        return []
    names = {int(folder.rpartition(f"{BUCKET}=")[2]): folder for folder in last["folders"]}
    old = _read_folders(spark, root, [names[b] for b in touched if b in names], schema)
    highest = 0
    if surrogate and last["folders"]:
        highest = _read_folders(spark, root, last["folders"], schema).agg(F.max(surrogate)).first()[0] or 0
    merged = merge(old, rows, highest).withColumn(BUCKET, bucket)
    part, _ = _new_part(merged.repartition(F.col(BUCKET)), root, check, last["buckets"])
    names |= {b: f"{part}/{BUCKET}={b}" for b in touched}
    content = {"folders": [names[b] for b in sorted(names)], "schema": schema.json(), "keys": keys, "buckets": last["buckets"]}
    content["notes"] = notes or {}
    _write_list(spark, root, (known or [0])[-1] + 1, content)
    return touched


def version_folders(spark: SparkSession, root: str, number: int | None = None) -> list[str]:
    """Folders that a version consists of, the newest by default."""
    known = _versions(spark, root)
    if not known:
        raise FileNotFoundError(f"no version of {root}")
    return [f"{root}/{folder}" for folder in _list_of(spark, root, number or known[-1])["folders"]]


def version_notes(spark: SparkSession, root: str) -> dict | None:
    """Notes of the newest version; None if there is no version or it is not kept in buckets."""
    known = _versions(spark, root)
    content = _list_of(spark, root, known[-1]) if known else {}
    return content.get("notes", {}) if content.get("buckets") else None


def read_parts(spark: SparkSession, root: str, folders: list[str]) -> DataFrame:
    """Rows of some folders of the newest version, as ``version_folders`` names them."""
    content = _list_of(spark, root, _versions(spark, root)[-1])
    inside = [folder.removeprefix(f"{root}/") for folder in folders]
    return _read_folders(spark, root, inside, T.StructType.fromJson(json.loads(content["schema"])))


def read_version(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """A version of a table, the newest by default."""
    known = _versions(spark, root)
    if not known:
        raise FileNotFoundError(f"no version of {root}")
    content = _list_of(spark, root, number or known[-1])
    return _read_folders(spark, root, content["folders"], T.StructType.fromJson(json.loads(content["schema"])))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per data set named in a run manifest."""
    manifest = spark.read.option("multiLine", True).json(path)
    return manifest.select(F.explode("datasets").alias("entry")).select("entry.*")


def require_datasets(manifest: DataFrame, required: Iterable[str]) -> None:
    """Raise naming the required data sets the manifest lacks."""
    wanted = manifest.sparkSession.createDataFrame([(name,) for name in required], "dataset_name string")
    missing = wanted.join(manifest.select("dataset_name"), "dataset_name", "left_anti").collect()
    if missing:
        raise ValueError(f"missing required data sets: {sorted(r.dataset_name for r in missing)}")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_claims(claims: DataFrame, path: str) -> None:
    """One ``- claim`` line per sentence."""
    claims.select(F.concat(F.lit("- "), F.col("claim"))).write.mode("overwrite").text(path)


def write_metadata(spark: SparkSession, metadata: dict, path: str) -> None:
    """Model metadata as one JSON line."""
    line = spark.createDataFrame([(json.dumps(metadata, sort_keys=True),)], "value string")
    line.write.mode("overwrite").text(path)


def read_metadata(spark: SparkSession, path: str) -> dict:
    """Model metadata as ``write_metadata`` wrote it."""
    return json.loads(spark.read.text(path).first().value)
