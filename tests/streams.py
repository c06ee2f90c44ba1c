"""Run an operator over ordered JSON files, one file per micro-batch."""

from __future__ import annotations

import json
import os
import time

from tidehouse import schemas
from tidehouse.functions import timefns

FAR = 4_000_000_000_000


def log_row(mid, ts, *, last=None, uid=None, is_new="0", page="home", sid=None, during=1, **more):
    common = {"mid": mid, "is_new": is_new, "uid": uid, "sid": sid, "ar": "1", "sc": "2", "vc": "v1"}
    record = {"common": {k: v for k, v in common.items() if v is not None},
              "page": {"page_id": page, "during_time": during}, "ts": ts, **more}
    if last is not None:
        record["page"]["last_page_id"] = last
    return record


def write_files(folder, batches):
    """One file per batch, of records or of plain text; file times keep the order."""
    os.makedirs(folder, exist_ok=True)
    start = time.time() - 10_000
    for n, batch in enumerate(batches):
        path = os.path.join(folder, f"{n:05d}.json")
        with open(path, "w") as out:
            out.write("".join((row if isinstance(row, str) else json.dumps(row)) + "\n" for row in batch))
        os.utime(path, (start + n, start + n))


def read_stream(spark, folder, delay=None, schema=schemas.LOG):
    df = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(folder)
    return timefns.with_event_time(df, delay=delay) if delay is not None else df


def read_batch(spark, folder, schema=schemas.LOG):
    return spark.read.schema(schema).json(folder)


def run(df, target, checkpoint):
    query = df.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()
    query.awaitTermination(240)
    assert not query.isActive
    if query.exception() is not None:
        raise query.exception()
    return df.sparkSession.read.schema(df.schema).parquet(target)
