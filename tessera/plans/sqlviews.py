"""DuckDB SQL text of the derived layers (oracle side).

The same formulas as ``layers.py``, written as CTEs over the driver's tables,
so every oracle query reads the whole tables.
"""

TRACK = """track AS (
  SELECT event_id AS fid, user_id AS id, ts,
         116e0 + ((event_id * 7919) % 10000) / 1e4 AS lon,
         39e0 + ((event_id * 104729) % 10000) / 1e4 AS lat,
         strftime(ts, '%Y%m%d%H') AS epoch
  FROM events)"""

POI = """poi AS (
  SELECT c_custkey AS fid, c_name AS name, c_mktsegment AS segment, c_acctbal AS balance,
         c_nationkey AS nationkey,
         116e0 + ((c_custkey * 6007) % 10000) / 1e4 AS lon,
         39e0 + ((c_custkey * 3571) % 10000) / 1e4 AS lat
  FROM customer)"""

ZONE = """zone AS (
  SELECT n_nationkey AS zone_id, n_name AS zone_name, n_regionkey AS regionkey,
         116e0 + (n_nationkey % 5) * 0.2e0 AS minx,
         39e0 + (n_nationkey // 5) * 0.2e0 AS miny,
         116e0 + (n_nationkey % 5) * 0.2e0 + 0.2e0 AS maxx,
         39e0 + (n_nationkey // 5) * 0.2e0 + 0.2e0 AS maxy
  FROM nation)"""

ROAD = """road AS (
  SELECT s_suppkey AS fid, s_name AS name,
         116e0 + (s_suppkey % 97) / 1e2 AS x1, 39e0 AS y1,
         116e0 + (s_suppkey % 89) / 1e2 AS x2, 40e0 AS y2
  FROM supplier)"""

SHAPE_ENV = """shape AS (
  SELECT p_partkey AS fid, p_name AS name, p_size AS size, p_partkey % 4 AS k,
         116e0 + ((p_partkey * 7919) % 10000) / 1e4 AS ax,
         39e0 + ((p_partkey * 7919) % 9973) / 1e4 AS ay,
         p_size / 1e3 AS s
  FROM part),
shape_env AS (
  SELECT fid, name, size, k, ax AS minx, ay AS miny,
         CASE WHEN k = 0 THEN ax ELSE ax + s END AS maxx,
         CASE WHEN k = 0 THEN ay ELSE ay + s END AS maxy
  FROM shape)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def ts(text: str) -> str:
    return f"TIMESTAMP '{text}'"


def dbl(v: float) -> str:
    """A double literal in both dialects."""
    return f"{float(v)!r}e0" if "e" not in repr(float(v)) else repr(float(v))


def edges_values(g) -> str:
    """VALUES list of a literal geometry's edges (x1, y1, x2, y2)."""
    rows = ", ".join(f"({dbl(a)}, {dbl(b)}, {dbl(c)}, {dbl(d)})" for a, b, c, d in g.edges())
    return f"(VALUES {rows}) AS e(x1, y1, x2, y2)"
