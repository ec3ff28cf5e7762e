"""DuckDB text of the fixture views and of the point rules, used by the oracle queries.

Only the driver's base tables are registered in DuckDB, so every oracle query starts with the CTEs it needs.
``with_views(names, body)`` prepends them in dependency order.
"""

from __future__ import annotations

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def _view(name: str, deps: tuple[str, ...], sql: str) -> None:
    VIEWS[name] = (deps, sql.strip())


_view("telemetry", (), """
SELECT event_id AS persist_key, epoch_us(ts) * 1000 AS timestamp_ns, event_type AS metric_name,
  CASE WHEN event_id % 97 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS gpu_id,
  'nvidia' || CAST(user_id % 8 AS VARCHAR) AS device,
  'GPU-' || CAST(user_id AS VARCHAR) AS uuid,
  CASE WHEN user_id % 3 = 0 THEN 'A100,PCIe' WHEN user_id % 3 = 1 THEN 'H100,SXM5' ELSE '' END AS model_name_csv,
  CASE WHEN user_id % 10 = 0 THEN '' ELSE 'ns' || CAST(user_id % 5 AS VARCHAR) END AS namespace,
  value,
  CASE event_id % 5
    WHEN 0 THEN 'k=' || regexp_extract(props, '([0-9]+)', 1) || ',source_node=node-' || CAST(event_id % 10 AS VARCHAR)
    WHEN 1 THEN ' k = ' || regexp_extract(props, '([0-9]+)', 1) || ' ,, flag ,source_node=node-' || CAST(event_id % 10 AS VARCHAR)
    WHEN 2 THEN 'k=1,k=2,expr=a=b,=orphan,source_node=node-' || CAST(event_id % 10 AS VARCHAR)
    WHEN 3 THEN 'namespace=from_label,gpu_id=label_gpu,source_node=node-' || CAST(event_id % 10 AS VARCHAR)
    ELSE '' END AS labels_raw,
  TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k
FROM events
""")

_view("enqueues", ("telemetry",), """
SELECT persist_key, timestamp_ns AS enqueued_ns,
  CASE WHEN persist_key % 50 = 0 THEN 'rejected' WHEN persist_key % 333 = 0 THEN 'invalid' ELSE 'enqueued' END AS outcome
FROM telemetry
""")

_view("dispatches", ("telemetry", "enqueues"), """
SELECT 'd1-' || CAST(t.persist_key AS VARCHAR) AS message_id, t.persist_key, t.timestamp_ns AS sent_ns
FROM telemetry t JOIN enqueues e ON t.persist_key = e.persist_key WHERE e.outcome = 'enqueued'
UNION ALL
SELECT 'd2-' || CAST(t.persist_key AS VARCHAR), t.persist_key, t.timestamp_ns + 40000000000
FROM telemetry t JOIN enqueues e ON t.persist_key = e.persist_key
WHERE e.outcome = 'enqueued' AND (t.metric_name = 'error' OR t.k > 30) AND t.persist_key % 2 = 0
""")

_view("acks", ("telemetry", "dispatches"), """
SELECT d.message_id, d.sent_ns + t.k * 1000000000 AS ack_ns
FROM dispatches d JOIN telemetry t ON d.persist_key = t.persist_key
WHERE d.message_id LIKE 'd1-%' AND t.metric_name <> 'error'
UNION ALL
SELECT d.message_id, d.sent_ns + 5000000000 FROM dispatches d WHERE d.message_id LIKE 'd2-%' AND d.persist_key % 4 = 0
UNION ALL
SELECT d.message_id, d.sent_ns + 100000000000 FROM dispatches d WHERE d.message_id LIKE 'd2-%' AND d.persist_key % 8 = 0
UNION ALL
SELECT 'ghost-' || CAST(persist_key AS VARCHAR), timestamp_ns FROM telemetry WHERE persist_key % 100 = 0
UNION ALL
SELECT '', timestamp_ns FROM telemetry WHERE persist_key % 500 = 0
""")

_view("attempts", (), """
SELECT l_orderkey AS message_key,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       l_quantity, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) - 1 AS BIGINT) AS attempt,
  CASE WHEN l_returnflag = 'A' THEN 'ResourceExhausted' WHEN l_returnflag = 'R' THEN 'Unavailable'
       WHEN l_linestatus = 'O' THEN 'OK' ELSE 'InvalidArgument' END AS code
FROM lineitem
""")

_view("assignments", (), """
SELECT CAST(o_custkey % 150 AS VARCHAR) AS gpu_id,
  1704067200000000000 + (o_orderkey % 720) * 3600000000000 AS from_ns,
  'wl-' || CAST(max(o_orderkey) AS VARCHAR) AS owner
FROM orders GROUP BY o_custkey % 150, o_orderkey % 720
""")

# Label text -> (key, value) with the last value of a repeated key; pieces trimmed of white space.
_view("label_kv", ("telemetry",), """
SELECT persist_key, k, arg_max(v, pos) AS v FROM (
  SELECT persist_key, pos,
    CASE WHEN strpos(piece, '=') > 0 THEN regexp_replace(substr(piece, 1, strpos(piece, '=') - 1), '^\\s+|\\s+$', '', 'g')
         ELSE piece END AS k,
    CASE WHEN strpos(piece, '=') > 0 THEN regexp_replace(substr(piece, strpos(piece, '=') + 1), '^\\s+|\\s+$', '', 'g')
         ELSE '' END AS v
  FROM (
    SELECT persist_key, pos, regexp_replace(piece, '^\\s+|\\s+$', '', 'g') AS piece FROM (
      SELECT persist_key, unnest(string_split(labels_raw, ',')) AS piece,
             generate_subscripts(string_split(labels_raw, ','), 1) AS pos
      FROM telemetry)
  ) WHERE piece <> ''
) WHERE k <> '' GROUP BY persist_key, k
""")

_view("tag_overrides", ("telemetry",), """
SELECT persist_key, 'gpu_id' AS k, gpu_id AS v FROM telemetry WHERE gpu_id <> ''
UNION ALL SELECT persist_key, 'device', device FROM telemetry WHERE device <> ''
UNION ALL SELECT persist_key, 'uuid', uuid FROM telemetry WHERE uuid <> ''
UNION ALL SELECT persist_key, 'namespace', namespace FROM telemetry WHERE namespace <> ''
UNION ALL SELECT persist_key, 'modelName', model_name_csv FROM telemetry WHERE model_name_csv <> ''
""")

_view("tags_long", ("label_kv", "tag_overrides"), """
SELECT l.persist_key, l.k, l.v FROM label_kv l
WHERE NOT EXISTS (SELECT 1 FROM tag_overrides o WHERE o.persist_key = l.persist_key AND o.k = l.k)
UNION ALL SELECT persist_key, k, v FROM tag_overrides
""")

_view("points", ("telemetry", "tags_long"), """
SELECT t.persist_key, 'gpu_metrics' AS measurement, t.timestamp_ns, t.metric_name, t.value,
  max(CASE WHEN g.k = 'gpu_id' THEN g.v END) AS gpu_id,
  max(CASE WHEN g.k = 'device' THEN g.v END) AS device,
  max(CASE WHEN g.k = 'uuid' THEN g.v END) AS uuid,
  max(CASE WHEN g.k = 'namespace' THEN g.v END) AS namespace,
  max(CASE WHEN g.k = 'modelName' THEN g.v END) AS model_name,
  max(CASE WHEN g.k = 'source_node' THEN g.v END) AS source_node,
  max(CASE WHEN g.k = 'k' THEN g.v END) AS tag_k,
  max(CASE WHEN g.k = 'flag' THEN g.v END) AS tag_flag,
  max(CASE WHEN g.k = 'expr' THEN g.v END) AS tag_expr,
  string_agg(g.k || '=' || g.v, ',' ORDER BY g.k) AS series_id
FROM telemetry t LEFT JOIN tags_long g ON t.persist_key = g.persist_key
GROUP BY t.persist_key, t.timestamp_ns, t.metric_name, t.value
""")


def with_views(names: tuple[str, ...] | list[str], body: str) -> str:
    """``WITH`` clause holding ``names`` and everything they depend on, followed by ``body``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in VIEWS[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    body = body.strip()
    if not order:
        return f"WITH {body.lstrip(',').strip()}" if body.startswith(",") else body
    ctes = ",\n".join(f"{n} AS (\n{VIEWS[n][1]}\n)" for n in order)
    # A body starting with ',' adds its own CTEs to the list.
    return f"WITH {ctes}\n{body}"
