"""Stateless operators on a streaming DataFrame.

The reference reads whole files eagerly and has no stream operators. All
row-wise operators here (PR*, SC*, fitted lookups such as FE7/FE8 joined as a
static table) run unchanged on a ``readStream`` source; this module wires one
such flow: file stream in, stream-static lookup join, file sink out, with the
stream checkpoint under the shared checkpoint folder.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..session import scratch_path


def run_available(spark: SparkSession, source: str, schema: StructType,
                  transform: Callable[[DataFrame], DataFrame], name: str,
                  fmt: str = "parquet") -> str:
    """Stream every file of the table at ``source`` (a file or a folder of files)
    through ``transform`` into a parquet folder (trigger availableNow), then stop. Returns the output path.

    The stream checkpoint and the output live under the shared checkpoint
    folder, so a restarted job resumes where it stopped.
    """
    base = os.path.join(scratch_path(spark, f"stream_{name}"), uuid.uuid4().hex)
    out, ckpt = os.path.join(base, "out"), os.path.join(base, "checkpoint")
    # a stream reads folders: a table that is one file is its folder's only matching file
    p = spark._jvm.org.apache.hadoop.fs.Path(source)
    r = spark.readStream.schema(schema).format(fmt)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isFile():
        r = r.option("pathGlobFilter", p.getName())
        source = p.getParent().toString()
    stream = r.load(source)
    q = (transform(stream).writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return out
