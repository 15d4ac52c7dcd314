"""Test views made from the driver's tables.

The driver's tables have no nulls and no exact duplicate rows, so nulls,
text tokens and duplicates are added by deterministic SQL.  The same SQL
text runs in Spark and in DuckDB (the oracle), so both sides see the same
rows.  Every view reads its whole base table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS: dict[str, str] = {
    # nulls at four rates: 1/3 CRITICAL, 1/7 and 1/13 WARNING, 1/101 INFO
    "customer_dirty": """
        SELECT c_custkey,
               CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
               CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
               CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey,
               CASE WHEN c_custkey % 101 = 0 THEN NULL ELSE c_name END AS c_name
        FROM customer""",
    # a projection of lineitem that repeats rows, with nulls in a key column
    "lineitem_dup": """
        SELECT CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_returnflag END AS l_returnflag,
               l_linestatus, l_linenumber, l_quantity
        FROM lineitem""",
    # price as text with an unparseable token, for the coercing cast
    "orders_text": """
        SELECT o_orderkey, o_orderstatus, o_orderpriority,
               CASE WHEN o_orderkey % 11 = 0 THEN 'N/A'
                    ELSE CAST(o_totalprice AS STRING) END AS o_totalprice_text
        FROM orders""",
    # infinities and nulls in a numeric column, for the sanitising step
    "customer_inf": """
        SELECT c_custkey,
               CASE WHEN c_custkey % 17 = 0 THEN CAST('Infinity' AS DOUBLE)
                    WHEN c_custkey % 19 = 0 THEN CAST('-Infinity' AS DOUBLE)
                    WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
               c_nationkey
        FROM customer""",
    # binary target with volume
    "events_labeled": """
        SELECT event_id, user_id, event_type, value,
               CAST(event_type = 'purchase' AS INT) AS is_purchase
        FROM events""",
    # a two-level category against the binary target (2 x 2 table)
    "events_parity": """
        SELECT event_id, CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS user_parity,
               event_type, CAST(event_type = 'purchase' AS INT) AS is_purchase
        FROM events""",
    # a scored table (label, prediction, probability) with many tied scores
    "events_scored": """
        SELECT event_id,
               CAST(event_type = 'purchase' AS INT) AS label,
               CAST(CAST(event_id * 37 % 1000 AS DOUBLE) / 1000 >= 0.5 AS INT) AS prediction,
               CAST(event_id * 37 % 1000 AS DOUBLE) / 1000 AS probability
        FROM events""",
    # three scoring "models" over the same events, with many tied scores
    "scored_runs": """
        SELECT event_id, 'm_random' AS model, 1 AS seq, CAST(event_type = 'purchase' AS INT) AS label,
               CAST(event_id * 37 % 1000 AS DOUBLE) / 1000 AS probability
        FROM events
        UNION ALL
        SELECT event_id, 'm_signal', 2, CAST(event_type = 'purchase' AS INT),
               CASE WHEN event_type = 'purchase' THEN 0.45 + CAST(event_id * 13 % 50 AS DOUBLE) / 100
                    ELSE CAST(event_id * 7 % 60 AS DOUBLE) / 100 END
        FROM events
        UNION ALL
        SELECT event_id, 'm_tuned', 3, CAST(event_type = 'purchase' AS INT),
               CASE WHEN event_type = 'purchase' THEN 0.3 + CAST(event_id * 11 % 70 AS DOUBLE) / 100
                    ELSE CAST(event_id * 3 % 55 AS DOUBLE) / 100 END
        FROM events""",
    # imbalanced binary target with document features
    "doc_features": """
        SELECT d.doc_id, d.lang, d.source, CAST(d.n_chars AS DOUBLE) AS n_chars, l.quality, l.toxic
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    # orders with a binary status target for contingency tests
    "orders_status": """
        SELECT o_orderkey, o_orderpriority, o_orderstatus, o_totalprice,
               CAST(o_orderstatus = 'F' AS INT) AS is_filled
        FROM orders""",
}


def register_base(spark: SparkSession, sf_dir: str, names=BASE_TABLES) -> None:
    for t in names:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table or one of :data:`VIEWS`, read from ``sf_dir``."""
    if name in VIEWS:
        register_base(spark, sf_dir, _bases_of(name))
        return spark.sql(VIEWS[name])
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bases_of(view: str) -> list[str]:
    sql = VIEWS[view]
    return [t for t in BASE_TABLES if f" {t}" in sql]


def oracle_with(sql: str, *views: str) -> str:
    """Prefix DuckDB SQL with the CTEs for ``views``."""
    if not views:
        return sql
    ctes = ",\n".join(f"{v} AS ({VIEWS[v]})" for v in views)
    body = sql.lstrip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
