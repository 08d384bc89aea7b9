"""Landings whose files have the documented names.

Spark's committer writes the shards into a hidden folder beside the landing; when all tasks are
committed each file is renamed to its shard's name, taking the place of the file of an earlier landing
under that name, and a record of the names and lengths is put in place last. A task or a job that
fails leaves no file: the hidden folder goes, and readers never look into it.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame

from ledgerlake import files, model
from ledgerlake.sinks import layout as L

RECORD = "_landed.json"
_PART = re.compile(r"part-(\d+)-.*?\.csv(\..*)?\Z")


def file_name(shard: int, n_shards: int, beam: bool = False, compression: str = "") -> str:
    return (model.BEAM_SHARD_NAME_FORMAT if beam else model.SHARD_NAME_FORMAT) % (shard, n_shards) + compression


def land_named(df: DataFrame, path: str, n_shards: int, beam: bool = False, header: bool = True, compression: str | None = None) -> list[str]:
    """Write ``df``, whose task ``p`` holds shard ``p`` of ``n_shards``, as CSV files with documented names; the names."""
    spark, hidden = df.sparkSession, f"{path}/_landing-{uuid.uuid4().hex[:12]}"
    try:
        L.write_csv(df, hidden, header=header, compression=compression)
        made: dict[str, str] = {}
        for name in files.names(spark, hidden):
            part = _PART.match(name)
            if part:
                if int(part[1]) >= n_shards:
                    raise ValueError(f"more tasks than the {n_shards} shards that there are names for")
                to = file_name(int(part[1]), n_shards, beam, part[2] or "")
                if to in made:
                    raise ValueError(f"two files for {to}: a task wrote more than one (spark.sql.files.maxRecordsPerFile)")
                made[to] = name
        for to, name in made.items():
            files.move(spark, f"{hidden}/{name}", f"{path}/{to}")
        files.put_text(spark, f"{path}/{RECORD}", json.dumps({n: files.length(spark, f"{path}/{n}") for n in made}, sort_keys=True), replace=True)
        return sorted(made)
    finally:
        files.remove(spark, hidden)
