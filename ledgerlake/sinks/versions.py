"""The published table by months, with versions.

Every publishing run writes a folder of its own. A small snapshot record, put in place by one
rename, names the live folder of each month; readers resolve the newest record first. So
a month changes as a whole: a reader sees the old one or the new one, a write that dies leaves the
old one, and nothing of a replaced month stays behind.

A run declares the days it covers. Months that lie in them are replaced as a whole, also by
nothing; of a month that is covered in part the live rows of the other days are carried over.
Rows outside the declared days are refused before anything becomes visible. Two runs that publish
at once both succeed if they cover different months; otherwise the second is refused.
"""

from __future__ import annotations

import calendar
import datetime as dt
import json
import re
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import files
from ledgerlake.sinks import layout as L

MONTH, VERSION, SNAPSHOTS = "mois", "version", "_snapshots"
_RECORD = re.compile(r"v(\d{12})\.json\Z")


class Conflict(Exception):
    """Another run published one of the same months in the meantime."""


class OutsideWindow(ValueError):
    """Rows lie outside the days that the run declared."""


@dataclass(frozen=True)
class Snapshot:
    """``months``: month -> folder under ``data``; ``schema``: of the table, as JSON."""

    seq: int = 0
    months: dict[str, str] = field(default_factory=dict)
    schema: str | None = None


def observed(seen: Observation, *names: str) -> dict[str, int]:
    """The counts of a finished write; zeros where the optimizer saw that there are no rows, and so ran nothing to count."""
    try:
        return seen.get
    except Py4JJavaError as e:
        if "AssertionError" not in e.java_exception.getClass().getName():
            raise
        return dict.fromkeys(names, 0)


def _record(root: str, seq: int) -> str:
    return f"{root}/{SNAPSHOTS}/v{seq:012d}.json"


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the snapshots, oldest first."""
    return [int(m[1]) for m in map(_RECORD.match, files.names(spark, f"{root}/{SNAPSHOTS}")) if m]


def read_snapshot(spark: SparkSession, root: str, seq: int | None = None) -> Snapshot:
    """The newest snapshot (or number ``seq``); an empty one if nothing was published."""
    known = versions(spark, root)
    if not known or seq == 0:
        return Snapshot()
    return Snapshot(**json.loads(files.read_text(spark, _record(root, known[-1] if seq is None else seq))))


def read_months(spark: SparkSession, root: str, seq: int | None = None, months: list[str] | None = None, snapshot: Snapshot | None = None) -> DataFrame:
    """The published table: live folders alone, with the run's folder as the column ``version``."""
    snap = snapshot or read_snapshot(spark, root, seq)
    if snap.schema is None:
        raise FileNotFoundError(f"nothing was published under {root}")
    schema = T.StructType.fromJson(json.loads(snap.schema))
    paths = [f"{root}/data/{folder}/{MONTH}={m}" for m, folder in sorted(snap.months.items()) if months is None or m in months]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{root}/data").parquet(*paths)


def months_between(first: dt.date, last: dt.date) -> dict[str, bool]:
    """Months of the days ``first .. last``, and whether all of their days are among them."""
    out, day = {}, first.replace(day=1)
    while day <= last:
        end = day.replace(day=calendar.monthrange(day.year, day.month)[1])
        out[day.strftime("%Y-%m")] = first <= day and end <= last
        day = end + dt.timedelta(days=1)
    return out


def publish_days(df: DataFrame, root: str, first: dt.date, last: dt.date, run_id: str, partition_cols: tuple[str, ...] = ("pays", "produit"),
                 date_col: str = "date_op", sort_col: str | None = "mouvement_no") -> tuple[Snapshot, int]:
    """Replace the days ``first .. last`` of the table by ``df``; the new snapshot and the rows of ``df``."""
    spark = df.sparkSession
    snap = read_snapshot(spark, root)
    covered = months_between(first, last)
    inside = F.coalesce(F.col(date_col).between(F.lit(first), F.lit(last)), F.lit(False))
    seen = Observation()
    rows = df.withColumn(MONTH, F.date_format(date_col, "yyyy-MM")).observe(seen, F.count("*").alias("n"), F.count_if(~inside).alias("outside"))
    carried = [m for m, whole in covered.items() if not whole and m in snap.months]
    if carried:
        rows = rows.unionByName(read_months(spark, root, months=carried, snapshot=snap).filter(~inside).drop(VERSION))
    folder = f"{VERSION}={run_id}-{uuid.uuid4().hex[:8]}"  # never a folder that a reader may be in
    L.publish_partitioned(rows, f"{root}/data/{folder}", [MONTH, *partition_cols], dynamic=False, sort_col=sort_col)
    found = observed(seen, "n", "outside")
    if found["outside"]:
        raise OutsideWindow(f"{found['outside']} of {found['n']} rows lie outside {first} .. {last}")
    written = {n.split("=", 1)[1] for n in files.names(spark, f"{root}/data/{folder}") if n.startswith(f"{MONTH}=")}
    # Columns as a reader of the folders gets them: partition columns last.
    keys = [MONTH, *partition_cols]
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in rows.schema if f.name not in keys), T.StructField(VERSION, T.StringType()), *(T.StructField(k, rows.schema[k].dataType) for k in keys)])
    return _commit(spark, root, snap, covered, {m: folder for m in written}, schema.json()), found["n"]


def _commit(spark: SparkSession, root: str, base: Snapshot, covered, new: dict[str, str], schema: str) -> Snapshot:
    while True:
        now = read_snapshot(spark, root)
        changed = [m for m in covered if now.months.get(m) != base.months.get(m)]
        if changed:
            raise Conflict(f"{', '.join(changed)} published by another run since snapshot {base.seq}")
        months = {m: f for m, f in now.months.items() if m not in covered} | new
        snap = Snapshot(now.seq + 1, months, schema)
        try:
            files.put_text(spark, _record(root, snap.seq), json.dumps(snap.__dict__, sort_keys=True))
            return snap
        except files.Exists:
            continue  # somebody was faster: look again


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete folders that none of the last ``keep`` snapshots names (those of failed runs too; not for
    use while a run is publishing) and the older records. Returns the deleted folders."""
    known = versions(spark, root)
    live = {f for seq in known[-keep:] for f in read_snapshot(spark, root, seq).months.values()}
    gone = [n for n in files.names(spark, f"{root}/data") if n.startswith(f"{VERSION}=") and n not in live]
    for seq in known[:-keep]:
        files.remove(spark, _record(root, seq))
    for n in gone:
        files.remove(spark, f"{root}/data/{n}")
    return gone
