"""CSV scan and sinks (IO1-IO5).

Scans take an explicit schema (type inference is a separate opt-in pass).
Sinks write many part files in parallel; no ``coalesce(1)``.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.ids import row_index_reset
from ..session import scratch_path


def scan_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             infer: bool = False, multi_line: bool = False) -> DataFrame:
    """IO1: header CSV with an explicit schema; ``infer=True`` reads the file once more for types.

    Quotes inside a quoted field are doubled. ``multi_line`` allows line breaks
    in quoted fields (such a file is not split between tasks).
    """
    r = (spark.read.option("header", True).option("mode", "FAILFAST").option("escape", '"')
         .option("multiLine", multi_line))
    if schema is not None:
        r = r.schema(schema)
    elif infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """IO2: header CSV, no index column."""
    df.write.option("header", True).option("escape", '"').mode(mode).csv(path)
    return path


def write_csv_indexed(df: DataFrame, path: str, order: Sequence[str], index_label: str = "Id",
                      na_rep: str = "0", mode: str = "overwrite") -> str:
    """IO3: a 0-based row index column (in ``order``) first, NULLs written as ``na_rep``."""
    d = row_index_reset(df, order, index_label)
    d = d.select(index_label, *[c for c in df.columns if c not in order])
    d.write.option("header", True).option("escape", '"').option("nullValue", na_rep).mode(mode).csv(path)
    return path


def submission(df: DataFrame, id_col: str, pred_col: str, out_id: str | None = None,
               out_pred: str | None = None, cast: str = "int") -> DataFrame:
    """IO4: id column + prediction column cast (no positional zip)."""
    return df.select(F.col(id_col).alias(out_id or id_col), F.col(pred_col).cast(cast).alias(out_pred or pred_col))


def wide_submission(df: DataFrame, id_col: str, proba_col: str, classes: Sequence[str]) -> DataFrame:
    """IO5: one probability column per class, in the given (sorted) class order."""
    return df.select(id_col, *[F.col(proba_col)[i].alias(c) for i, c in enumerate(classes)])


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (see ``ensure_checkpoint_dir``)."""
    return os.path.join(scratch_path(spark, name), uuid.uuid4().hex)
