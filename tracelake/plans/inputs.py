"""Points, boxes and map objects read from the given tables; the same SQL text serves both engines."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("events", "part", "documents", "embeddings", "pages", "lineitem", "orders", "customer", "nation", "region", "supplier")

SQL = {
    "pts": """
SELECT concat('traj_', user_id) AS dataset_name, concat('scene_', user_id) AS scene_token, concat('A', user_id % 5) AS city_id, concat('sub_', user_id % 4) AS subdataset_name, seq,
  CAST(1704067200 + seq + 5 * floor((seq - 1) / CAST(20 AS DOUBLE)) AS BIGINT) AS ts,
  CAST(116.3 AS DOUBLE) + CAST(user_id % 10 AS DOUBLE) * CAST(0.002 AS DOUBLE) + CAST(seq AS DOUBLE) * CAST(0.0001 AS DOUBLE) + CAST(0.00003 AS DOUBLE) AS lon,
  CAST(39.9 AS DOUBLE) + CAST(floor(user_id / CAST(10 AS DOUBLE)) % 3 AS DOUBLE) * CAST(0.002 AS DOUBLE) + CAST(event_id % 7 AS DOUBLE) * CAST(0.00001 AS DOUBLE) + CAST(0.00003 AS DOUBLE) AS lat,
  least(value / CAST(10 AS DOUBLE), CAST(35 AS DOUBLE)) AS twist_linear, CAST(event_id % 63 AS DOUBLE) * CAST(0.1 AS DOUBLE) AS yaw,
  CASE WHEN event_type = 'error' THEN NULL WHEN event_type IN ('click', 'purchase') THEN 1 ELSE 0 END AS avp_flag,
  CASE WHEN user_id % 7 = 0 AND seq = 1 THEN 1 ELSE 2 END AS workstage
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq FROM events) e""",
    "boxes": """
SELECT dataset_name, scene_token, city_id, subdataset_name, min(lon) AS xmin, max(lon) AS xmax, min(lat) AS ymin, max(lat) AS ymax, bool_and(workstage = 2) AS all_good FROM pts GROUP BY 1, 2, 3, 4""",
    "crossings": """
SELECT p_partkey AS intersection_id, p_size % 8 + 1 AS intersectiontype, p_partkey % 7 + 1 AS intersectionsubtype,
  CAST(116.3 AS DOUBLE) + CAST(p_partkey % 300 AS DOUBLE) * CAST(0.0001 AS DOUBLE) AS xmin, CAST(39.9 AS DOUBLE) + CAST(p_partkey % 60 AS DOUBLE) * CAST(0.0001 AS DOUBLE) AS ymin,
  CAST(116.3 AS DOUBLE) + CAST(p_partkey % 300 + 2 AS DOUBLE) * CAST(0.0001 AS DOUBLE) AS xmax, CAST(39.9 AS DOUBLE) + CAST(p_partkey % 60 + 2 AS DOUBLE) * CAST(0.0001 AS DOUBLE) AS ymax FROM part""",
    "edges": """
SELECT p_partkey AS roadid, (p_partkey * 7 + 1) % (SELECT count(*) FROM part) AS nextroadid, CAST(p_size AS DOUBLE) * CAST(5 AS DOUBLE) AS length FROM part""",
    "scenes": """
SELECT concat('scene_', doc_id) AS scene_id, source AS subdataset_name, concat('obs://store/god/', source, '/train_god_', doc_id, '.shrink') AS obs_path, 1 + length(source) % 4 + doc_id % 1 AS duplication_factor, lang, n_chars, doc_id FROM documents""",
    "hits": """
SELECT vec_id, concat('traj_', vec_id % 20) AS dataset_name, CAST(1704067200000 AS BIGINT) + vec_id * 60000 AS timestamp_ms, CAST(label AS DOUBLE) / CAST(10 AS DOUBLE) AS similarity FROM embeddings""",
}
NEEDS = {"boxes": ("pts",)}
OWN = "tracelake_"  # before the names of the views that inputs are read through


def prefix(*names: str) -> str:
    """``WITH`` clauses that define inputs."""
    order = []
    for n in names:
        order += [m for m in (*NEEDS.get(n, ()), n) if m not in order]
    return "WITH RECURSIVE " + ", ".join(f"{n} AS ({SQL[n]})" for n in order)


def own(sql: str) -> str:
    """The SQL with input names prefixed, so that views of the session keep theirs."""
    return re.sub(rf"\b(FROM|JOIN) ({'|'.join((*TABLES, *SQL))})\b", rf"\1 {OWN}\2", sql)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or one of the inputs above."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    for table in TABLES:
        if table in SQL[name] or any(table in SQL[n] for n in NEEDS.get(name, ())):
            read(spark, sf_dir, table).createOrReplaceTempView(OWN + table)
    for need in NEEDS.get(name, ()):
        spark.sql(own(SQL[need])).createOrReplaceTempView(OWN + need)
    return spark.sql(own(SQL[name]))
