"""Oracle SQL (DuckDB dialect) for the registered queries.

Written independently of the Spark code, from the reference's semantics:
the fixture views are plain SELECTs over the given tables, followed by the
operator in SQL. Queries whose result is not expressible in SQL (model fits,
random draws) have no entry here.
"""

from __future__ import annotations

FIX = {
    "bids": """bids AS (
  SELECT event_id AS bid_id, user_id AS bidder_id,
         concat(event_type, '-', CAST(day(ts) % 5 AS VARCHAR)) AS auction,
         event_type AS merchandise, ts AS time,
         k AS device, k % 13 AS url,
         CASE WHEN k % 11 = 0 THEN NULL ELSE k % 7 END AS country
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) ev)""",
    "bidders": """bidders AS (
  SELECT c_custkey AS bidder_id,
         CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS outcome,
         CASE WHEN c_custkey % 4 = 0 THEN 'test' ELSE 'train' END AS split
  FROM customer)""",
    "passengers": """passengers AS (
  SELECT p_partkey AS row_id, p_partkey AS PassengerId,
         CASE WHEN p_partkey % 4 = 0 THEN 'test' ELSE 'train' END AS split,
         CASE WHEN p_partkey % 4 = 0 THEN NULL
              WHEN p_type IN ('PROMO','SMALL') THEN 1 ELSE 0 END AS Survived,
         concat(split_part(p_name,' ',1), ', ',
                CASE p_partkey % 7 WHEN 0 THEN 'Mr' WHEN 1 THEN 'Miss' WHEN 2 THEN 'Mrs'
                  WHEN 3 THEN 'Master' WHEN 4 THEN 'Col' WHEN 5 THEN 'Zed' ELSE 'Ms' END,
                '. ', split_part(p_name,' ',2)) AS Name,
         CASE WHEN p_partkey % 2 = 0 THEN 'male' ELSE 'female' END AS Sex,
         CASE WHEN p_partkey % 5 = 0 OR p_partkey % 7 = 5 THEN NULL
              ELSE CAST(p_size AS DOUBLE) END AS Age,
         CAST(p_partkey % 3 AS INTEGER) AS SibSp, CAST(p_partkey % 4 AS INTEGER) AS Parch,
         CAST(p_partkey % 3 + 1 AS INTEGER) AS Pclass,
         CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_retailprice END AS Fare,
         CASE WHEN p_partkey % 4 <> 1 THEN NULL
              ELSE concat(CASE p_size % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'C' ELSE 'F G' END,
                          CAST(p_size AS VARCHAR)) END AS Cabin,
         CASE WHEN p_partkey % 90 = 1 THEN NULL WHEN p_partkey % 3 = 0 THEN 'S'
              WHEN p_partkey % 3 = 1 THEN 'C' ELSE 'Q' END AS Embarked
  FROM part)""",
    "incidents": """incidents AS (
  SELECT event_id AS row_id, event_id AS Id, ts AS Dates, event_type AS Category,
         CASE WHEN user_id % 7 = 0 OR event_id % 5 = 0 THEN 'test' ELSE 'train' END AS split,
         concat(CAST(user_id AS VARCHAR),
                CASE WHEN user_id % 3 = 0 THEN ' A / B' ELSE ' BLOCK' END) AS Address,
         concat('D', CAST(user_id % 10 AS VARCHAR)) AS PdDistrict,
         dayname(ts) AS DayOfWeek,
         value AS X, CAST(event_id % 97 AS DOUBLE) AS Y
  FROM events)""",
    "digits": """digits AS (
  SELECT vec_id AS row_id, label, embedding AS px, 8 AS width FROM embeddings)""",
    "votes": """votes AS (
  SELECT vec_id AS row_id, label,
         CAST((vec_id * 2 + label * 0) % 4 AS INTEGER) AS p0,
         CAST((vec_id * 3 + label * 1) % 4 AS INTEGER) AS p1,
         CAST((vec_id * 4 + label * 2) % 4 AS INTEGER) AS p2,
         CAST((vec_id * 5 + label * 3) % 4 AS INTEGER) AS p3,
         CAST((vec_id * 6 + label * 4) % 4 AS INTEGER) AS p4,
         ((vec_id * 37) % 101) / CAST(100 AS DOUBLE) AS s1,
         ((vec_id * 53) % 101) / CAST(100 AS DOUBLE) AS s2
  FROM embeddings)""",
}


def with_fix(names, body: str) -> str:
    """``WITH <fixture views>, <body ctes...>`` helper; ``body`` may start with
    further CTEs (``x AS (...), ...``) followed by the final SELECT."""
    head = ",\n".join(FIX[n] for n in names)
    body = body.strip()
    if body.upper().startswith("SELECT"):
        return f"WITH {head}\n{body}"
    return f"WITH {head},\n{body}"


SQL: dict[str, str] = {}


def register(name: str, fixtures, body: str) -> None:
    if fixtures:
        SQL[name] = with_fix(fixtures, body)
    else:
        b = body.strip()
        SQL[name] = b if b.upper().startswith(("SELECT", "WITH")) else f"WITH {b}"
