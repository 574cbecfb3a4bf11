"""Registered queries: arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...sources import fixtures as fx
from ..registry import query
from ...functions import arrays as AR
from ...operators import image as IM


def _shift_sql(dr, dc):
    return f"""list_transform(px, lambda x, i:
        CASE WHEN (i - 1) // 8 + ({dr}) BETWEEN 0 AND len(px) // 8 - 1
              AND (i - 1) % 8 + ({dc}) BETWEEN 0 AND 7
             THEN px[((i - 1) // 8 + ({dr})) * 8 + (i - 1) % 8 + ({dc}) + 1]
             ELSE CAST(0 AS FLOAT) END)"""


@query("array_scale", ["digits"], "SELECT row_id, list_transform(px, lambda x: CAST(x / CAST(255 AS DOUBLE) AS FLOAT)) AS px FROM digits")
def array_scale(spark, d):
    """AR1."""
    return fx.digits(spark, d).select("row_id", AR.array_scale("px", 255.0).alias("px"))


@query("array_grid", ["digits"], """
SELECT row_id, list_transform(range(0, len(px) // 8), lambda r: px[r * 8 + 1 : r * 8 + 8]) AS grid FROM digits""")
def array_grid(spark, d):
    """AR2: flat 64 -> 8 x 8."""
    return fx.digits(spark, d).select("row_id", AR.to_grid("px", "width").alias("grid"))


@query("array_shift", ["digits"], f"SELECT row_id, {_shift_sql(1, 0)} AS up FROM digits")
def array_shift(spark, d):
    """AR3: picture moved up one pixel, zero border."""
    dr, dc = AR.SHIFTS["up"]
    return fx.digits(spark, d).select("row_id", AR.shift_grid("px", "width", dr, dc).alias("up"))


@query("augment_shift", ["digits"], " UNION ALL ".join(
    f"SELECT row_id, label, width, {k} AS variant, {expr} AS px FROM digits"
    for k, expr in enumerate(["px", _shift_sql(1, 0), _shift_sql(0, 1), _shift_sql(0, -1), _shift_sql(-1, 0)])))
def augment_shift(spark, d):
    """AR4: x5 rows: original, up, left, right, down."""
    return IM.augment_shift(fx.digits(spark, d), "px", "width")


@query("stack_variants", ["digits"], """
SELECT row_id, label, width, 0 AS variant, px FROM digits
UNION ALL
SELECT row_id, label, width, 1 AS variant, list_transform(px, lambda x: CAST(x / CAST(255 AS DOUBLE) AS FLOAT)) FROM digits""")
def stack_variants(spark, d):
    """ST6: a table over its transformed copy, from one scan."""
    return IM.stack_variants(fx.digits(spark, d), "px", [F.col("px"), AR.array_scale("px", 255.0)])


_PLURALITY = """v AS (SELECT row_id, [p0, p1, p2, p3, p4] AS a FROM votes),
e AS (SELECT row_id, unnest(a) AS x, generate_subscripts(a, 1) AS i FROM v),
c AS (SELECT *, count(*) OVER (PARTITION BY row_id, x) AS n FROM e)
SELECT row_id, x AS vote FROM
  (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY n DESC, i ASC) AS rn FROM c) z WHERE rn = 1"""


@query("vote_plurality", ["votes"], _PLURALITY)
def vote_plurality(spark, d):
    """AR5/ML14: plurality of five model votes, ties to the earliest model."""
    v = fx.votes(spark, d)
    return v.select("row_id", AR.plurality_vote(F.array(*[f"p{m}" for m in range(5)])).alias("vote"))


@query("augment_rotate")
def augment_rotate(spark, d):
    """AR6: repeatable random rotation in [-7, 7) degrees (rows-only; invariants unit-tested)."""
    return IM.augment_rotate(fx.digits(spark, d), "px", "width", "row_id", seed=1)


@query("align_predictions", ["votes"], """
l AS (SELECT row_id, 0 AS model, p0 AS pred FROM votes UNION ALL SELECT row_id, 1, p1 FROM votes
      UNION ALL SELECT row_id, 2, p2 FROM votes UNION ALL SELECT row_id, 3, p3 FROM votes
      UNION ALL SELECT row_id, 4, p4 FROM votes)
SELECT row_id, list(pred ORDER BY model) AS preds FROM l GROUP BY row_id""")
def align_predictions(spark, d):
    """AR7: long (row, model, prediction) table -> per-row list in model order."""
    v = fx.votes(spark, d)
    long = v.select("row_id", F.posexplode(F.array(*[f"p{m}" for m in range(5)])).alias("model", "pred"))
    return IM.align_predictions(long, "row_id", "model", "pred", "preds")
