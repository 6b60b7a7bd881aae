"""Relations with the shape of the engine's inputs, derived from the star-schema tables.

The definitions are SQL that Spark and DuckDB read alike, in whole numbers unless a cast says otherwise, so that both
engines agree bit for bit. ``{name}`` stands for a table or an earlier relation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings")

RELATIONS: dict[str, str] = {
    "scan": """
SELECT o_orderkey AS img_id, 800 + (o_orderkey * 7919) % 1200 AS w, 400 + (o_orderkey * 104729) % 800 AS h,
  (CASE o_orderkey % 3 WHEN 0 THEN 'panoramic' WHEN 1 THEN 'teleradiography' ELSE 'misc' END) || '/' ||
  (CASE WHEN o_orderkey % 2 = 0 THEN 'a' ELSE 'a-b' END) || '/scan_patient_' || CAST(o_orderkey AS VARCHAR(20)) ||
  (CASE o_orderkey % 7 WHEN 0 THEN '.png' WHEN 1 THEN '.JPG' WHEN 2 THEN '.jpeg' WHEN 3 THEN '.tif' WHEN 4 THEN '.webp' WHEN 5 THEN '.txt' ELSE '.v2.png' END) AS name
FROM {orders}""",
    "numbered": """
SELECT l_orderkey AS img_id, l_partkey, l_suppkey, l_linenumber, l_discount, l_returnflag, l_linestatus, CAST(l_quantity AS BIGINT) AS q,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) AS BIGINT) - 1 AS ix
FROM {lineitem}""",
    "det_raw": """
SELECT n.img_id, n.ix, s.w, s.h, n.l_partkey, n.l_suppkey, n.l_linenumber, n.q, l_discount * 10 AS conf,
  (n.l_partkey * 13 + n.l_linenumber * 101) % s.w AS x1,
  CASE n.l_suppkey % 3 WHEN 0 THEN (n.l_suppkey * 7) % 60 WHEN 1 THEN s.h - 1 - (n.l_suppkey * 7) % 60 ELSE (n.l_suppkey * 31) % s.h END AS y1,
  20 + 12 * n.q AS bw, 10 + 2 * n.q AS bh,
  CASE WHEN n.l_linenumber = 4 THEN ' ' ELSE ' ' || n.l_returnflag || n.l_linestatus END AS text
FROM {numbered} n JOIN {scan} s ON n.img_id = s.img_id""",
    "det": """
SELECT img_id, ix, w, h, l_partkey, l_suppkey, l_linenumber, q, conf, text, bw, bh, x1, y1, x1 + bw AS x2, y1 + bh AS y2 FROM {det_raw}""",
    "pred": """
SELECT img_id, ix, CAST(x1 AS DOUBLE) AS x1, CAST(y1 AS DOUBLE) AS y1, CAST(x2 AS DOUBLE) AS x2, CAST(y2 AS DOUBLE) AS y2, conf, w, h
FROM {det} WHERE img_id % 11 <> 0 AND l_linenumber <= 5""",
    "gt_xywh": """
SELECT img_id, ix, CASE WHEN l_suppkey % 5 = 0 THEN (l_partkey * 29) % 700 ELSE x1 + l_partkey % 21 - 10 END AS x,
  CASE WHEN l_suppkey % 5 = 0 THEN (l_suppkey * 17) % 380 ELSE y1 + l_suppkey % 9 - 4 END AS y,
  CASE WHEN q = 1 THEN 0 ELSE bw + (l_partkey % 3) * 6 - 6 END AS bw, bh
FROM {det} WHERE l_linenumber <= 3 AND img_id % 13 <> 0""",
    "gt": """
SELECT img_id, ix, CAST(x AS DOUBLE) AS x1, CAST(y AS DOUBLE) AS y1, CAST(x + bw AS DOUBLE) AS x2, CAST(y + bh AS DOUBLE) AS y2 FROM {gt_xywh}""",
    "post": """
SELECT o_orderkey AS name, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderkey % 97 AS DOUBLE) / 10 END AS sam_time, CAST(o_orderkey % 53 AS DOUBLE) / 10 AS post_time
FROM {orders} WHERE o_orderkey % 19 <> 0""",
    "sam": """
SELECT o_orderkey AS name, 0 AS pos, CAST(o_orderkey % 89 AS DOUBLE) / 10 AS sam_time FROM {orders} WHERE o_orderkey % 5 <> 4
UNION ALL SELECT o_orderkey AS name, 1 AS pos, CAST(o_orderkey % 83 AS DOUBLE) / 10 AS sam_time FROM {orders} WHERE o_orderkey % 17 = 0""",
    "deid": """
SELECT o_orderkey AS name, 0 AS pos, CAST(o_orderkey % 71 AS DOUBLE) / 10 AS deid_time FROM {orders} WHERE o_orderkey % 3 <> 0""",
    "decisions": """
SELECT event_id AS pos, CASE WHEN event_type = 'error' THEN '' ELSE CAST(user_id AS VARCHAR(20)) END AS relpath,
  CASE event_type WHEN 'click' THEN 'ok' WHEN 'view' THEN 'bad' ELSE 'skip' END AS status
FROM {events}""",
}

#: Which relations or tables each relation reads, in the order they must be defined.
ORDER = tuple(RELATIONS)


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table or derived relation as a lazy DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = RELATIONS[name]
    needed = [n for n in (*TABLES, *ORDER) if "{" + n + "}" in sql]
    return spark.sql(sql, **{n: relation(spark, sf_dir, n) for n in needed})


def with_sql(body: str) -> str:
    """DuckDB SQL: the relations that ``body`` needs, as common table expressions, before it."""
    wanted: list[str] = []

    def need(text: str) -> None:
        for n in ORDER:
            if n not in wanted and "{" + n + "}" in text:
                need(RELATIONS[n])
                wanted.append(n)

    need(body)
    plain = {n: n for n in (*TABLES, *ORDER)}
    fill = lambda text: _format(text, plain)
    ctes = ",\n".join(f"{n} AS ({fill(RELATIONS[n])})" for n in wanted)
    own = fill(body).strip()
    if not ctes:
        return own
    if own.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {ctes},\n{own[len('WITH RECURSIVE') :]}"
    if own.upper().startswith("WITH"):
        return f"WITH {ctes},\n{own[len('WITH') :]}"
    return f"WITH {ctes}\n{own}"


def _format(text: str, names: dict[str, str]) -> str:
    for n, plain in names.items():
        text = text.replace("{" + n + "}", plain)
    return text
