"""DuckDB SQL for every registered query that SQL can express.

Each text is one SELECT over common table expressions that spell out the same
logs, splits and samples from the given tables.
"""

from __future__ import annotations

from rastro.plans.adapters import EVENT_NAMES, FLAG_NAMES, TWICE_DELIVERED
from rastro.plans.catalog import (
    EPOCHS,
    EVAL_NEGATIVES,
    SAMPLE_USERS,
    TEST_USERS,
    TOOL_RESOURCES,
    TOP_N,
    TOP_PRODUCTS,
    TRAIN_NEGATIVES,
)
from rastro.plans.fixed import FIXED_CENTERS
from rastro.schemas import CLUSTER_NAMES, EVENT_WEIGHTS, FEATURE_COLUMNS


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _case(column: str, names: dict, otherwise: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in names.items())
    return f"CASE {column} {whens} ELSE {otherwise} END"


def _named(column: str, names: dict[str, str]) -> str:
    return _case(column, {k: f"'{v}'" for k, v in names.items()}, column)


EVENTS_LOG = f"""
  delivered AS (SELECT * FROM events UNION ALL
    SELECT * FROM events WHERE event_type IN ({_quoted(TWICE_DELIVERED)})),
  log AS (SELECT epoch_us(ts) // 1000 AS "timestamp",
    CASE WHEN event_type <> 'signup' THEN user_id END AS visitorid,
    {_named("event_type", EVENT_NAMES)} AS event,
    CAST(nullif(CAST(json_extract_string(props, '$.k') AS BIGINT), 0) AS DOUBLE) AS itemid,
    CASE WHEN event_type = 'purchase' THEN CAST(event_id AS DOUBLE) END AS transactionid
    FROM delivered)"""

ORDERS_LOG = f"""
  log AS (SELECT epoch_us(o_orderdate) // 1000 AS "timestamp", o_custkey AS visitorid,
    {_named("l_returnflag", FLAG_NAMES)} AS event,
    CAST(l_partkey AS DOUBLE) AS itemid,
    CASE WHEN l_returnflag = 'N' THEN CAST(l_orderkey AS DOUBLE) END AS transactionid
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_DATETIME = 'make_timestamp("timestamp" * 1000) AS fecha'
_WEIGHT = f"CAST({_case('event', EVENT_WEIGHTS, '1')} AS INTEGER) AS peso_implicito"
_HOUR_WEEKDAY = (
    'CAST(hour(make_timestamp("timestamp" * 1000)) AS INTEGER) AS hora_del_dia, '
    'CAST(isodow(make_timestamp("timestamp" * 1000)) AS INTEGER) AS dia_semana'
)
_VALID = f"event IN ({_quoted(EVENT_WEIGHTS)})"

CLEAN = f""",
  clean AS (SELECT "timestamp", visitorid, event, CAST(itemid AS BIGINT) AS itemid, transactionid
    FROM (SELECT DISTINCT * FROM log)
    WHERE itemid IS NOT NULL AND visitorid IS NOT NULL AND {_VALID}),
  tr AS (SELECT *, {_DATETIME}, {_WEIGHT}, {_HOUR_WEEKDAY} FROM clean)"""

_FEATURES = """SELECT visitorid, count(*) AS total_interacciones,
    count(DISTINCT itemid) AS productos_distintos,
    CAST(sum(peso_implicito) AS BIGINT) AS peso_total,
    CAST(sum(CASE WHEN event = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS views,
    CAST(sum(CASE WHEN event = 'addtocart' THEN 1 ELSE 0 END) AS BIGINT) AS carritos,
    CAST(sum(CASE WHEN event = 'transaction' THEN 1 ELSE 0 END) AS BIGINT) AS compras
    FROM tr GROUP BY visitorid"""


def _scaled_cte() -> str:
    logs = ", ".join(f"ln(1 + {c}) AS {c}" for c in FEATURE_COLUMNS)
    moments = ", ".join(
        f"avg({c}) AS avg_{c}, stddev_pop({c}) AS std_{c}" for c in FEATURE_COLUMNS
    )
    scaled = ", ".join(
        f"CASE WHEN std_{c} = 0 THEN 0.0 ELSE ({c} - avg_{c}) / std_{c} END AS {c}"
        for c in FEATURE_COLUMNS
    )
    return f""",
  features AS ({_FEATURES}),
  logs AS (SELECT visitorid, {logs} FROM features),
  moments AS (SELECT {moments} FROM logs),
  scaled AS (SELECT visitorid, {scaled} FROM logs CROSS JOIN moments)"""


def _segments_cte() -> str:
    distances = ", ".join(
        " + ".join(f"({c} - ({v})) * ({c} - ({v}))" for c, v in zip(FEATURE_COLUMNS, center))
        + f" AS d{j}"
        for j, center in enumerate(FIXED_CENTERS)
    )
    least = "least(" + ", ".join(f"d{j}" for j in range(len(FIXED_CENTERS))) + ")"
    label = " ".join(f"WHEN d{j} = {least} THEN {j}" for j in range(len(FIXED_CENTERS)))
    return _scaled_cte() + f""",
  distances AS (SELECT visitorid, {distances} FROM scaled),
  labels_ AS (SELECT visitorid, CAST(CASE {label} END AS INTEGER) AS cluster FROM distances),
  segments AS (SELECT features.*, cluster FROM features JOIN labels_ USING (visitorid))"""


SPLIT = """,
  ranked AS (SELECT *, row_number() OVER (PARTITION BY visitorid ORDER BY "timestamp" DESC,
      itemid DESC, event DESC, transactionid DESC NULLS LAST) AS rn,
    count(*) OVER (PARTITION BY visitorid) AS n FROM tr),
  test AS (SELECT * EXCLUDE (rn, n) FROM ranked WHERE rn = 1 AND n >= 2),
  train AS (SELECT * EXCLUDE (rn, n) FROM ranked WHERE rn <> 1 OR n < 2),
  known AS (SELECT * FROM test WHERE visitorid IN (SELECT visitorid FROM train)
    AND itemid IN (SELECT itemid FROM train)),
  seen AS (SELECT DISTINCT visitorid, itemid FROM train)"""

INDEX = """,
  users AS (SELECT visitorid, row_number() OVER (ORDER BY visitorid) - 1 AS u_idx
    FROM (SELECT DISTINCT visitorid FROM train)),
  items AS (SELECT itemid, row_number() OVER (ORDER BY itemid) - 1 AS i_idx
    FROM (SELECT DISTINCT itemid FROM train)),
  seen_idx AS (SELECT u_idx, i_idx FROM seen JOIN users USING (visitorid) JOIN items USING (itemid)),
  positives AS (SELECT u_idx, i_idx, "timestamp", event, CAST(transactionid AS BIGINT) AS tx
    FROM train JOIN users USING (visitorid) JOIN items USING (itemid)),
  pairs AS (SELECT u_idx, i_idx FROM known JOIN users USING (visitorid) JOIN items USING (itemid))"""


def _lists_cte(name: str, score: str) -> str:
    """Top-N unseen items per user under a score per item."""
    return f""",
  {name}_items AS (SELECT itemid, CAST({score} AS DOUBLE) AS score FROM train GROUP BY itemid),
  {name}_places AS (SELECT *, row_number() OVER (ORDER BY score DESC, itemid) AS place
    FROM {name}_items),
  {name}_pool AS (SELECT visitorid, itemid, score
    FROM (SELECT visitorid, count(*) AS n_seen FROM seen GROUP BY visitorid)
    JOIN {name}_places ON place <= n_seen + {TOP_N}),
  {name}_unseen AS (SELECT * FROM {name}_pool ANTI JOIN seen USING (visitorid, itemid)),
  {name} AS (SELECT visitorid, CAST(rank AS INTEGER) AS rank, itemid, score FROM (SELECT *,
      row_number() OVER (PARTITION BY visitorid ORDER BY score DESC, itemid) AS rank
      FROM {name}_unseen)
    WHERE rank <= {TOP_N})"""


def _metrics(ranked: str) -> str:
    k = TOP_N
    return f"""SELECT count(*) AS usuarios_evaluados,
    round(avg(CASE WHEN rank <= {k} THEN 1 ELSE 0 END), 6) AS "hit_rate@{k}",
    round(avg(CASE WHEN rank <= {k} THEN 1.0::DOUBLE / rank ELSE 0 END), 6) AS "map@{k}",
    round(avg(CASE WHEN rank <= {k} THEN 1.0::DOUBLE / log2(rank + 1) ELSE 0 END), 6) AS "ndcg@{k}"
    FROM {ranked}"""


def _ranked_test(lists: str) -> str:
    return f"(SELECT known.visitorid, rank FROM known LEFT JOIN {lists} USING (visitorid, itemid))"


_HITS = f"""SELECT visitorid, CAST(CASE WHEN rank <= {TOP_N} THEN 1 ELSE 0 END AS INTEGER) AS hit
    FROM {_ranked_test("lists")}"""


def _hash(*parts: str) -> str:
    text = "concat_ws(':', " + ", ".join(f"CAST({p} AS VARCHAR)" for p in parts) + ")"
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


_N_ITEMS = "(SELECT count(*) FROM items)"

TRAIN_NEG = f""",
  tries AS (SELECT positives.*, t, {_hash("42", "0", "u_idx", "i_idx", '"timestamp"', "event", "tx", "t")}
      % {_N_ITEMS} AS drawn
    FROM positives, range({10 * TRAIN_NEGATIVES}) r(t)),
  accepted AS (SELECT tries.* FROM tries
    ANTI JOIN seen_idx ON tries.u_idx = seen_idx.u_idx AND drawn = seen_idx.i_idx),
  first_ones AS (SELECT u_idx, drawn AS i_idx, row_number() OVER
      (PARTITION BY u_idx, i_idx, "timestamp", event, tx ORDER BY t) AS place FROM accepted)"""

# Two rounds of tries, then draws from the unseen items themselves.
EVAL_NEG = f""",
  tries AS (SELECT u_idx, i_idx, t, {_hash("42", "0", "u_idx", "i_idx", "t")}
      % {_N_ITEMS} AS neg_idx
    FROM pairs, range({6 * EVAL_NEGATIVES}) r(t)),
  accepted AS (SELECT tries.* FROM tries
    ANTI JOIN seen_idx ON tries.u_idx = seen_idx.u_idx AND neg_idx = seen_idx.i_idx
    WHERE neg_idx <> i_idx),
  tried AS MATERIALIZED (SELECT u_idx, i_idx, neg_idx FROM (SELECT *, row_number() OVER
      (PARTITION BY u_idx, i_idx ORDER BY t) AS place FROM accepted)
    WHERE place <= {EVAL_NEGATIVES}),
  hard AS (SELECT u_idx, i_idx, {EVAL_NEGATIVES} - coalesce(n, 0) AS missing FROM pairs
    LEFT JOIN (SELECT u_idx, i_idx, count(*) AS n FROM tried GROUP BY ALL) USING (u_idx, i_idx)
    WHERE coalesce(n, 0) < {EVAL_NEGATIVES}),
  unseen AS (SELECT h.u_idx, h.i_idx, missing, list(items.i_idx ORDER BY items.i_idx) AS left_over
    FROM hard h, items WHERE items.i_idx <> h.i_idx AND NOT EXISTS
      (SELECT 1 FROM seen_idx s WHERE s.u_idx = h.u_idx AND s.i_idx = items.i_idx)
    GROUP BY ALL),
  eval_neg AS (SELECT * FROM tried UNION ALL
    SELECT u_idx, i_idx, left_over[1 + {_hash("42", "0", "u_idx", "i_idx", f"({6 * EVAL_NEGATIVES} + d)")}
      % len(left_over)] AS neg_idx
    FROM (SELECT *, unnest(range(missing)) AS d FROM unseen))"""


def _factor_cte(name: str, key: str) -> str:
    counts = ", ".join(
        f"CAST(count(*) FILTER (event = '{e}') AS DOUBLE) AS {e[0]}" for e in EVENT_WEIGHTS
    )
    return f", {name} AS (SELECT {key}, {counts} FROM positives GROUP BY {key})"


FACTORS_SQL = _factor_cte("uf", "u_idx") + _factor_cte("vf", "i_idx")
_DOT = "uf.v * vf.v + uf.a * vf.a + uf.t * vf.t"

_UNSEEN = f""",
  scored AS (SELECT visitorid, itemid, users.u_idx, items.i_idx, {_DOT} AS score FROM users JOIN uf USING (u_idx)
    CROSS JOIN items JOIN vf USING (i_idx)),
  unseen AS (SELECT * FROM scored ANTI JOIN seen_idx USING (u_idx, i_idx))"""
_PLACES = _UNSEEN + """,
  asked AS (SELECT known.visitorid, known.itemid, i_idx, score FROM known JOIN scored USING (visitorid, itemid)),
  places AS (SELECT a.visitorid, a.itemid,
      CASE WHEN NOT bool_or(seen.itemid IS NOT NULL) THEN 1 + count(*) FILTER (
        u.score > a.score OR (u.score = a.score AND u.i_idx < a.i_idx)) END AS rank
    FROM asked a JOIN unseen u USING (visitorid)
    LEFT JOIN seen ON seen.visitorid = a.visitorid AND seen.itemid = a.itemid GROUP BY ALL)"""

_REQUESTS = """(SELECT CAST(hour(ts) AS INTEGER) AS n_concurrentes, value AS latencia_s,
    (epoch_us(ts) // 1000) / 1000.0::DOUBLE AS inicio_s, event_type = 'error' AS error FROM events)"""

_SUMMARY = """SELECT l_returnflag AS etiqueta, l_linenumber AS workers,
    round(avg(l_extendedprice), 4) AS media_s,
    round(coalesce(stddev_samp(l_extendedprice), 0), 4) AS std_s,
    round(min(l_extendedprice), 4) AS min_s, round(max(l_extendedprice), 4) AS max_s,
    count(*) AS n_repeticiones
    FROM lineitem GROUP BY l_returnflag, l_linenumber"""

_SCALING = """SELECT l_returnflag AS etiqueta, l_linenumber AS workers,
    round(sum(l_extendedprice * l_discount)
      + sum(l_extendedprice * (1 - l_discount)) / l_linenumber, 2) AS media_s
    FROM lineitem GROUP BY l_returnflag, l_linenumber"""


def _with_base(table: str) -> str:
    return f"""(SELECT t.*, base FROM ({table}) t JOIN (SELECT etiqueta, max(media_s) AS base
    FROM ({table}) WHERE workers = 1 GROUP BY etiqueta) b USING (etiqueta))"""


def _even(value: str, digits: int) -> str:
    return f"round_even(({value}) * {10**digits}, 0) / {10**digits}"


_SPEEDUPS = f"""SELECT etiqueta, workers, media_s, {_even("base / media_s", 3)} AS speedup
    FROM {_with_base(_SCALING)}"""


def _on_events(body: str, *extra: str) -> str:
    return f"WITH {EVENTS_LOG}{CLEAN}{''.join(extra)}\n{body}"


def _on_orders(body: str, *extra: str) -> str:
    return f"WITH {ORDERS_LOG}{CLEAN}{''.join(extra)}\n{body}"


def _on_train(body: str, *extra: str) -> str:
    return _on_orders(body, SPLIT, INDEX, *extra)


def _quality(label: str, log: str) -> str:
    return f"""SELECT filas, ts_unicos, eliminadas,
    round(ts_unicos / filas, 6) AS proporcion_ts,
    ts_unicos / filas < 0.01 AND eliminadas / filas > 0.02 AS alerta, '{label}' AS registro
    FROM (WITH {log}{CLEAN} SELECT (SELECT count(*) FROM log) AS filas,
      (SELECT count(DISTINCT "timestamp") FROM log) AS ts_unicos,
      (SELECT count(*) FROM log) - (SELECT count(*) FROM clean) AS eliminadas)"""


def _properties(column: str) -> str:
    return f"""SELECT epoch_us(l_shipdate) // 1000 AS "timestamp", l_partkey AS itemid,
    '{column}' AS property, {column} AS value FROM lineitem"""


def _synthetic() -> str:
    def uniform(j: int, part: int) -> str:
        return f"((CAST({_hash('42', 'o_orderkey', str(j), str(part))} AS DOUBLE) + 0.5) / 1152921504606846976.0::DOUBLE)"

    columns = ", ".join(
        f"round(exp(1.5::DOUBLE + 1.2::DOUBLE * (sqrt(-2.0::DOUBLE * ln({uniform(j, 0)})) "
        f"* cos(2.0::DOUBLE * pi() * {uniform(j, 1)}))), 6) AS f{j}"
        for j in range(6)
    )
    return f"SELECT o_orderkey, {columns} FROM orders"


def _scaled_profile() -> str:
    columns = [c for c in FEATURE_COLUMNS if c != "peso_total"]
    means = ", ".join(f"avg({c}) AS {c}" for c in columns)
    scaled = ", ".join(
        f"round(CASE WHEN max({c}) OVER () = min({c}) OVER () THEN 0.0 ELSE "
        f"({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) END, 6) AS {c}"
        for c in columns
    )
    return f"""SELECT cluster, {scaled} FROM (SELECT cluster, {means} FROM segments
    WHERE cluster <> (SELECT max(cluster) FROM segments) GROUP BY cluster)"""


def _rounded(table: str) -> str:
    columns = ", ".join(f"round({c}, 6) AS {c}" for c in FEATURE_COLUMNS)
    return f"SELECT visitorid, {columns} FROM {table}"


def _compare() -> str:
    rows = []
    for metric, value in (
        ("hit_rate", "CASE WHEN rank <= {k} THEN 1.0::DOUBLE ELSE 0 END"),
        ("map", "CASE WHEN rank <= {k} THEN 1.0::DOUBLE / rank ELSE 0 END"),
        ("ndcg", "CASE WHEN rank <= {k} THEN 1.0::DOUBLE / log2(rank + 1) ELSE 0 END"),
    ):
        value = value.format(k=TOP_N)
        rows.append(
            f"SELECT '{metric}@{TOP_N}' AS metrica, "
            f"(SELECT avg({value}) FROM {_ranked_test('lists')}) AS peso, "
            f"(SELECT avg({value}) FROM {_ranked_test('others')}) AS eventos"
        )
    return f"""SELECT metrica, round(peso, 6) AS peso, round(eventos, 6) AS eventos,
    round(CASE WHEN peso <> 0 THEN 100.0::DOUBLE * (eventos - peso) / peso END, 4)
      AS mejora_eventos_pct
    FROM ({" UNION ALL ".join(rows)})"""


def _stage_means(stage: str) -> str:
    return f"avg(o_totalprice) FILTER (o_orderstatus = '{stage}')"


_LISTS = _lists_cte("lists", "sum(peso_implicito)")
_OTHERS = _lists_cte("others", "count(*)")
_CLUSTER_NAME = " ".join(f"WHEN {k} THEN '{v}'" for k, v in CLUSTER_NAMES.items())
_RESOURCES = _case("herramienta", TOOL_RESOURCES, "NULL")

_LISTS_HOLD = f"""SELECT visitorid,
    least({TOP_N}, (SELECT count(*) FROM items) - count(*))::BIGINT AS recomendados,
    0::BIGINT AS huecos, 0::BIGINT AS vistos
    FROM seen {{who}} GROUP BY visitorid"""
_FEATURES_CTE = f", features AS ({_FEATURES})"

ORACLE: dict[str, str] = {
    "src_detect_sep": """SELECT doc_id,
        CASE WHEN length(line) - length(replace(line, ';', ''))
          > length(line) - length(replace(line, ',', '')) THEN ';' ELSE ',' END AS separador
        FROM (SELECT doc_id, split_part(text, chr(10), 1) AS line FROM documents)""",
    "src_events_csv": _on_events("SELECT * FROM log"),
    "src_malformed": _on_events(
        """SELECT count(*) AS filas, count(*) FILTER (itemid < 50) AS mal_formadas
        FROM log WHERE event = 'view'"""
    ),
    "src_excel_ts": _on_events(
        """SELECT "timestamp" AS exacto, CAST(CAST(substr(CAST("timestamp" AS VARCHAR), 1, 1)
        || '.' || substr(CAST("timestamp" AS VARCHAR), 2, 5) || 'E+12' AS DOUBLE) AS BIGINT)
        AS "timestamp" FROM log"""
    ),
    "src_category_tree": "SELECT l_partkey AS categoryid, l_suppkey AS parentid FROM lineitem",
    "src_item_props": _properties("l_returnflag"),
    "src_item_props_union": f"{_properties('l_returnflag')} UNION ALL {_properties('l_linestatus')}",
    "src_path_fallback": _on_events("SELECT * FROM log"),
    "src_parquet": _on_events("SELECT * FROM clean"),
    "sink_events_parquet": _on_events("SELECT * FROM tr"),
    "sink_parquet": _on_events("SELECT * FROM segments", _segments_cte()),
    "sink_csv": _SUMMARY,
    "sink_json": _on_train(_compare(), _LISTS, _OTHERS),
    "src_subset": _on_events(
        """SELECT visitorid, itemid FROM (SELECT *, row_number() OVER (ORDER BY visitorid, itemid)
        AS place, count(*) OVER () AS n FROM (SELECT DISTINCT visitorid, itemid FROM clean))
        WHERE place <= n // 2"""
    ),
    "src_synth_features": _synthetic(),
    "clean_dedupe": _on_events("SELECT DISTINCT * FROM log"),
    "clean_not_null": _on_events(
        "SELECT * FROM log WHERE itemid IS NOT NULL AND visitorid IS NOT NULL"
    ),
    "clean_valid_event": _on_events(f"SELECT * FROM log WHERE {_VALID}"),
    "clean_cast_item": _on_events("SELECT * REPLACE (CAST(itemid AS BIGINT) AS itemid) FROM log"),
    "clean_events": _on_events("SELECT * FROM clean"),
    "ext_stream_clean": _on_events("SELECT * FROM clean"),
    "ext_stream_counts": _on_events(
        """SELECT time_bucket(INTERVAL 1 HOUR, fecha) AS inicio,
        time_bucket(INTERVAL 1 HOUR, fecha) + INTERVAL 1 HOUR AS fin, event, count(*) AS cantidad
        FROM tr GROUP BY ALL"""
    ),
    "clean_report": _on_events(
        """SELECT a AS filas_antes, b AS filas_despues, a - b AS eliminadas,
        round(100 * (a - b) / a, 2) AS pct_eliminadas
        FROM (SELECT (SELECT count(*) FROM log) AS a, (SELECT count(*) FROM clean) AS b)"""
    ),
    "quality_ts_precision": f"{_quality('exacto', EVENTS_LOG)} UNION ALL {_quality('dias', ORDERS_LOG)}",
    "clean_category_tree": """SELECT l_partkey AS categoryid, min(l_suppkey) AS parentid
        FROM lineitem GROUP BY l_partkey""",
    "tr_epoch_ms": _on_events(f"SELECT *, {_DATETIME} FROM clean"),
    "tr_weight": _on_events(f"SELECT *, {_WEIGHT} FROM log"),
    "tr_hour_weekday": _on_events(f"SELECT *, {_HOUR_WEEKDAY} FROM clean"),
    "tr_events": _on_events("SELECT * FROM tr"),
    "tr_cluster_name": _on_orders(
        f"SELECT visitorid, cluster, CASE cluster {_CLUSTER_NAME} END AS cluster_nombre FROM segments",
        _segments_cte(),
    ),
    "tr_log1p": _on_events(_rounded("logs"), _scaled_cte()),
    "agg_user_features": _on_events(_FEATURES),
    "agg_interactions": _on_orders(
        """SELECT visitorid, itemid, CAST(sum(peso_implicito) AS BIGINT) AS peso
        FROM tr GROUP BY visitorid, itemid"""
    ),
    "agg_matrix_density": _on_orders(
        """SELECT usuarios, productos, nnz,
        round(100.0::DOUBLE * nnz / (usuarios * productos), 6) AS densidad_pct
        FROM (SELECT count(DISTINCT visitorid) AS usuarios, count(DISTINCT itemid) AS productos,
          count(*) AS nnz FROM (SELECT DISTINCT visitorid, itemid FROM tr))"""
    ),
    "agg_event_counts": _on_events("SELECT event, count(*) AS cantidad FROM tr GROUP BY event"),
    "agg_hourly": _on_events(
        "SELECT hora_del_dia, count(*) AS interacciones FROM tr GROUP BY hora_del_dia"
    ),
    "agg_top_products": _on_orders(
        f"""SELECT itemid, count(*) AS interacciones FROM tr GROUP BY itemid
        ORDER BY interacciones DESC, itemid LIMIT {TOP_PRODUCTS}"""
    ),
    "agg_kpis": _on_orders(
        """SELECT (SELECT count(*) FROM tr) AS eventos_totales,
        (SELECT count(*) FROM segments) AS usuarios_unicos,
        (SELECT count(DISTINCT itemid) FROM tr) AS productos_distintos,
        (SELECT count(DISTINCT cluster) FROM segments) AS clusters""",
        _segments_cte(),
    ),
    "agg_kpis_days": _on_orders(
        """SELECT strftime(fecha, '%Y-%m') AS periodo, count(*) AS eventos_totales,
        true AS usuarios_dentro, true AS productos_dentro FROM tr GROUP BY periodo"""
    ),
    "agg_cluster_size": _on_orders(
        "SELECT cluster, count(*) AS usuarios FROM segments GROUP BY cluster", _segments_cte()
    ),
    "agg_cluster_profile": _on_orders(
        "SELECT cluster, "
        + ", ".join(f"round(avg({c}), 6) AS {c}" for c in FEATURE_COLUMNS)
        + " FROM segments GROUP BY cluster",
        _segments_cte(),
    ),
    "agg_cluster_minmax": _on_orders(_scaled_profile(), _segments_cte()),
    "win_recency_rank": _on_events(
        """SELECT visitorid, "timestamp", itemid, event, rn AS rank_reciente FROM ranked""", SPLIT
    ),
    "semi_evaluable": _on_events(
        """SELECT * FROM clean WHERE visitorid IN
        (SELECT visitorid FROM clean GROUP BY visitorid HAVING count(*) >= 2)"""
    ),
    "split_loo_test": _on_orders("SELECT * FROM test", SPLIT),
    "split_loo_train": _on_orders("SELECT * FROM train", SPLIT),
    "join_known_in_train": _on_orders("SELECT * FROM known", SPLIT),
    "index_ids": _on_events(
        """SELECT visitorid, row_number() OVER (ORDER BY visitorid) - 1 AS u_idx
        FROM (SELECT DISTINCT visitorid FROM clean)"""
    ),
    "index_dictionary": _on_events(
        """SELECT visitorid, row_number() OVER (ORDER BY carga, visitorid) - 1 AS u_idx, carga
        FROM (SELECT visitorid, CASE WHEN min("timestamp") <= (SELECT (min("timestamp")
            + max("timestamp")) // 2 FROM clean) THEN 'a' ELSE 'b' END AS carga
          FROM clean GROUP BY visitorid)"""
    ),
    "user_log_features": _on_orders(_FEATURES),
    "user_log_evaluable": _on_orders(
        """SELECT * FROM tr WHERE visitorid IN
        (SELECT visitorid FROM tr GROUP BY visitorid HAVING count(*) >= 2)"""
    ),
    "user_log_split_test": _on_orders("SELECT * FROM test", SPLIT),
    "user_log_split_train": _on_orders("SELECT * FROM train", SPLIT),
    "join_id_index": _on_orders(
        """SELECT visitorid, itemid, CAST(sum(peso_implicito) AS BIGINT) AS peso,
        dense_rank() OVER (ORDER BY visitorid) - 1 AS u_idx,
        dense_rank() OVER (ORDER BY itemid) - 1 AS i_idx
        FROM tr GROUP BY visitorid, itemid"""
    ),
    "anti_seen": _on_train("SELECT visitorid, itemid, score FROM lists_unseen", _LISTS),
    "set_user_items": _on_orders("SELECT DISTINCT visitorid, itemid FROM tr"),
    "set_union_all": (
        f"SELECT * FROM (WITH {EVENTS_LOG} SELECT * FROM log) UNION ALL "
        f"SELECT * FROM (WITH {ORDERS_LOG} SELECT * FROM log)"
    ),
    "limit_test_users": _on_orders(
        f"SELECT * FROM test ORDER BY visitorid LIMIT {TEST_USERS}", SPLIT
    ),
    "sample_users": _on_orders(
        f"""SELECT visitorid FROM (SELECT DISTINCT visitorid FROM tr)
        ORDER BY md5('42:' || CAST(visitorid AS VARCHAR)), visitorid LIMIT {SAMPLE_USERS}"""
    ),
    "seg_scale": _on_orders(_rounded("scaled"), _scaled_cte()),
    "seg_assign": _on_orders("SELECT visitorid, cluster FROM segments", _segments_cte()),
    "rec_neg_train": _on_train(
        f"""SELECT u_idx, i_idx, 1.0::DOUBLE AS label, CAST(0 AS INTEGER) AS epoch FROM positives
        UNION ALL SELECT u_idx, i_idx, 0.0::DOUBLE, 0 FROM first_ones
        WHERE place <= {TRAIN_NEGATIVES}""",
        TRAIN_NEG,
    ),
    "rec_neg_eval": _on_train("SELECT * FROM eval_neg", EVAL_NEG),
    "rec_topn_batch_holds": _on_train(_LISTS_HOLD.format(who="")),
    "rec_topn_user_holds": _on_train(
        _LISTS_HOLD.format(who="WHERE visitorid = (SELECT min(visitorid) FROM train)")
    ),
    "rec_sample_export_holds": _on_train(
        _LISTS_HOLD.format(
            who=f"""WHERE visitorid IN (SELECT visitorid FROM users
            ORDER BY md5('42:' || CAST(visitorid AS VARCHAR)), visitorid LIMIT {SAMPLE_USERS})"""
        )
    ),
    "rec_als_holds": _on_train(
        """SELECT 'usuario' AS tipo, count(*) AS ids, count(*) AS filas, 0::BIGINT AS malas FROM users
        UNION ALL SELECT 'producto', count(*), count(*), 0 FROM items"""
    ),
    "rec_neural_loss_holds": f"SELECT {EPOCHS}::BIGINT AS epocas, 0::BIGINT AS malas, true AS baja",
    "rec_als_plain_holds": _on_train("SELECT count(*) AS productos, 0::BIGINT AS malos FROM items"),
    "rec_neural_holds": _on_train("SELECT count(*) AS pares, 0::BIGINT AS fuera FROM pairs"),
    "seg_kmeans_holds": _on_orders("SELECT count(*) AS usuarios, 0::BIGINT AS lejos FROM features", _FEATURES_CTE),
    "seg_relabel_holds": _on_orders(
        "SELECT 6::BIGINT AS segmentos, count(*) AS usuarios, 0::BIGINT AS caidas FROM features", _FEATURES_CTE
    ),
    "seg_project_2d_holds": _on_orders(
        "SELECT count(*) AS usuarios, 0::BIGINT AS perdidos FROM features", _FEATURES_CTE
    ),
    "seg_dispersion_holds": _on_orders(
        """SELECT cluster, count(*) AS usuarios,
        round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM segments), 1) AS porcentaje
        FROM segments GROUP BY cluster""",
        _segments_cte(),
    ),
    "ext_popularity": _on_train(
        f"""SELECT o_orderkey AS visitorid, CAST(rank AS INTEGER) AS rank, itemid, score
        FROM orders, (SELECT itemid, CAST(sum(peso_implicito) AS DOUBLE) AS score,
            row_number() OVER (ORDER BY sum(peso_implicito) DESC, itemid) AS rank
          FROM train GROUP BY itemid)
        WHERE rank <= {TOP_N} AND o_orderkey NOT IN (SELECT visitorid FROM train)"""
    ),
    "rec_neg_shortfall": _on_train(
        f"""SELECT positivos, negativos, {TRAIN_NEGATIVES} * positivos - negativos AS faltan
        FROM (SELECT (SELECT count(*) FROM positives) AS positivos,
          (SELECT count(*) FROM first_ones WHERE place <= {TRAIN_NEGATIVES}) AS negativos)""",
        TRAIN_NEG,
    ),
    "rec_neg_epochs": _on_train(
        " UNION ALL ".join(
            f"""SELECT u_idx, drawn AS i_idx, CAST({epoch} AS INTEGER) AS epoch
            FROM (SELECT *, row_number() OVER (PARTITION BY u_idx, i_idx, "timestamp", event, tx
              ORDER BY t) AS place FROM (SELECT positives.*, t,
                {_hash("42", str(epoch), "u_idx", "i_idx", '"timestamp"', "event", "tx", "t")}
                % {_N_ITEMS} AS drawn FROM positives, range({10 * TRAIN_NEGATIVES}) r(t)) tries
              ANTI JOIN seen_idx ON tries.u_idx = seen_idx.u_idx AND drawn = seen_idx.i_idx)
            WHERE place <= {TRAIN_NEGATIVES}"""
            for epoch in (0, 1)
        )
    ),
    "rec_score_pairs": _on_train(
        f"""SELECT s.u_idx, s.i_idx, {_DOT} AS score FROM seen_idx s
        JOIN uf ON s.u_idx = uf.u_idx JOIN vf ON s.i_idx = vf.i_idx""",
        FACTORS_SQL,
    ),
    "rank_recs": _on_train("SELECT * FROM lists", _LISTS),
    "sort_recs_user": _on_train(
        "SELECT * FROM lists WHERE visitorid = (SELECT min(visitorid) FROM lists)", _LISTS
    ),
    "rec_users": _on_train("SELECT DISTINCT visitorid FROM lists", _LISTS),
    "eval_full": _on_train(_metrics(_ranked_test("lists")), _LISTS),
    "eval_places": _on_train("SELECT * FROM places", FACTORS_SQL, _PLACES),
    "eval_full_counted": _on_train(_metrics("places"), FACTORS_SQL, _PLACES),
    "rec_topn_fixed": _on_train(
        f"""SELECT visitorid, CAST(rank AS INTEGER) AS rank, itemid, score FROM (
          SELECT *, row_number() OVER (PARTITION BY visitorid ORDER BY score DESC, i_idx) AS rank FROM unseen)
        WHERE rank <= {TOP_N}""",
        FACTORS_SQL,
        _UNSEEN,
    ),
    "eval_hits_user": _on_train(_HITS, _LISTS),
    "join_hits_segments": _on_train(
        f"SELECT visitorid, hit, cluster FROM ({_HITS}) LEFT JOIN segments USING (visitorid)",
        _LISTS,
        _segments_cte(),
    ),
    "agg_hit_by_cluster": _on_train(
        f"""SELECT cluster, round(avg(hit), 6) AS "hit_rate@{TOP_N}",
        count(*) AS n_usuarios_evaluados
        FROM ({_HITS}) LEFT JOIN segments USING (visitorid) GROUP BY cluster""",
        _LISTS,
        _segments_cte(),
    ),
    "eval_sampled": _on_train(
        _metrics("true_ranks"),
        EVAL_NEG,
        FACTORS_SQL,
        f""",
  true_scores AS (SELECT p.u_idx, p.i_idx, {_DOT} AS score FROM pairs p
    JOIN uf ON p.u_idx = uf.u_idx JOIN vf ON p.i_idx = vf.i_idx),
  neg_scores AS (SELECT n.u_idx, n.i_idx, {_DOT} AS score FROM eval_neg n
    JOIN uf ON n.u_idx = uf.u_idx JOIN vf ON n.neg_idx = vf.i_idx),
  true_ranks AS (SELECT t.u_idx, t.i_idx, 1 + count(*) FILTER (n.score >= t.score) AS rank
    FROM true_scores t JOIN neg_scores n ON t.u_idx = n.u_idx AND t.i_idx = n.i_idx
    GROUP BY t.u_idx, t.i_idx)""",
    ),
    "eval_compare": _on_train(_compare(), _LISTS, _OTHERS),
    "perf_summary": _SUMMARY,
    "perf_speedup": f"""SELECT * EXCLUDE (base), {_even("speedup / workers", 3)} AS eficiencia
        FROM (SELECT *, {_even("base / media_s", 3)} AS speedup FROM {_with_base(_SUMMARY)})""",
    "perf_weak_eff": f"""SELECT * EXCLUDE (base), {_even("base / media_s", 3)} AS eficiencia_debil
        FROM {_with_base(_SUMMARY)}""",
    "perf_amdahl_fit": f"""WITH points AS ({_SPEEDUPS}),
      merged AS (SELECT etiqueta, CAST(workers AS DOUBLE) AS n, avg(speedup) AS s, count(*) AS w
        FROM points GROUP BY etiqueta, workers),
      grid AS (SELECT i / 10000.0::DOUBLE AS f FROM range(10001) g(i)),
      errors AS (SELECT etiqueta, f, sum(w * (s - 1 / (f + (1 - f) / n)) ** 2) AS e
        FROM merged CROSS JOIN grid GROUP BY etiqueta, f),
      best AS (SELECT etiqueta, arg_min(f, e) AS fraccion_secuencial FROM errors GROUP BY etiqueta)
      SELECT etiqueta, fraccion_secuencial, CASE WHEN fraccion_secuencial <> 0
        THEN round(1 / fraccion_secuencial, 4) END AS speedup_maximo FROM best""",
    "perf_amdahl_point": f"""SELECT etiqueta, workers, speedup, round(s, 4) AS fraccion_secuencial,
        CASE WHEN s <> 0 THEN round(1 / s, 4) END AS speedup_limite
        FROM (SELECT *, (1.0::DOUBLE / speedup - 1.0::DOUBLE / workers) / (1 - 1.0::DOUBLE / workers)
          AS s FROM ({_SPEEDUPS}) WHERE workers > 1)""",
    "perf_weak_linear": """SELECT l_returnflag AS etiqueta,
        round(regr_intercept(l_extendedprice, l_linenumber), 3) AS a,
        round(regr_slope(l_extendedprice, l_linenumber), 3) AS b
        FROM lineitem GROUP BY l_returnflag""",
    "perf_best_config": f"""SELECT etiqueta,
        max(media_s) FILTER (workers = 1) AS tiempo_secuencial_s, min(media_s) AS mejor_tiempo_s,
        arg_min(workers, media_s) AS mejor_configuracion,
        {_even("max(media_s) FILTER (workers = 1) / min(media_s)", 3)} AS speedup_maximo
        FROM ({_SUMMARY}) GROUP BY etiqueta""",
    "perf_stage_share": f"""SELECT CASE WHEN grouping(o_orderstatus) = 1 THEN 'TOTAL'
        ELSE o_orderstatus END AS etapa, round(sum(o_totalprice), 4) AS tiempo_s,
        {_even("100 * sum(o_totalprice) / (SELECT sum(o_totalprice) FROM orders)", 1)}
          AS porcentaje_del_total
        FROM orders GROUP BY ROLLUP (o_orderstatus)""",
    "perf_batch_latency": """SELECT p_size AS tamano_lote, round(s, 6) AS latencia_media_s,
        round(s * 1000, 4) AS latencia_media_ms,
        round(s / p_size * 1000, 4) AS latencia_por_usuario_ms,
        round(p_size / s, 4) AS throughput_usuarios_por_s
        FROM (SELECT p_size, avg(p_retailprice) AS s FROM part GROUP BY p_size)""",
    "perf_load_stats": f"""SELECT n_concurrentes, count(*) AS n_solicitudes,
        round(max(inicio_s + latencia_s) - min(inicio_s), 3) AS tiempo_total_s,
        round(count(*) / (max(inicio_s + latencia_s) - min(inicio_s)), 6) AS throughput_req_por_s,
        round(avg(latencia_s) * 1000, 3) AS latencia_media_ms,
        round(quantile_cont(latencia_s, 0.50) * 1000, 3) AS latencia_p50_ms,
        round(quantile_cont(latencia_s, 0.95) * 1000, 3) AS latencia_p95_ms,
        round(quantile_cont(latencia_s, 0.99) * 1000, 3) AS latencia_p99_ms,
        round(max(latencia_s) * 1000, 3) AS latencia_max_ms,
        count(*) FILTER (error) AS n_errores,
        round(count(*) FILTER (error) / count(*), 6) AS tasa_error
        FROM {_REQUESTS} GROUP BY n_concurrentes""",
    "perf_balance": """SELECT count(*) AS n_workers, count(busy) AS workers_con_trabajo_asignado,
        round(avg(busy), 4) AS media_tiempo_ocupado_s,
        round(stddev_pop(busy), 4) AS std_tiempo_ocupado_s,
        round(stddev_pop(busy) / avg(busy), 6) AS coef_variacion,
        round(sum(moved), 4) AS tiempo_transferencia_total_s
        FROM (SELECT l_suppkey, sum(l_quantity) FILTER (l_linestatus = 'O') AS busy,
          sum(l_quantity) FILTER (l_linestatus <> 'O') AS moved FROM lineitem GROUP BY l_suppkey)""",
    "perf_tool_stages": f"""WITH means AS (SELECT o_orderpriority AS herramienta,
        {_stage_means("O")} AS o, {_stage_means("F")} AS f, {_stage_means("P")} AS p
        FROM orders GROUP BY o_orderpriority),
      totals AS (SELECT *, o + f + p AS total, CAST({_RESOURCES} AS INTEGER) AS recursos_usados
        FROM means),
      gains AS (SELECT *, {_even("(SELECT total FROM totals WHERE herramienta = '1-URGENT') / total", 2)}
        AS speedup FROM totals)
      SELECT herramienta, round(o, 4) AS "O_s", round(f, 4) AS "F_s", round(p, 4) AS "P_s",
        round(total, 4) AS total_s, speedup, recursos_usados,
        {_even("speedup / recursos_usados", 3)} AS eficiencia FROM gains""",
    "perf_hotspots": """SELECT 'f' || CAST(l_suppkey AS VARCHAR) AS funcion, count(*) AS llamadas,
        round(sum(l_quantity), 4) AS tiempo_propio_s,
        round(sum(l_extendedprice), 4) AS tiempo_acumulado_s
        FROM lineitem GROUP BY l_suppkey ORDER BY tiempo_acumulado_s DESC, funcion LIMIT 15""",
    "perf_breakeven": """SELECT *, round(tiempo_cpu_s / tiempo_gpu_s, 2) AS speedup
        FROM (SELECT l_partkey AS n_filas,
          round(avg(l_extendedprice) FILTER (l_linestatus = 'O'), 6) AS tiempo_cpu_s,
          round(avg(l_extendedprice) FILTER (l_linestatus = 'F'), 6) AS tiempo_gpu_s
          FROM lineitem GROUP BY l_partkey)
        WHERE tiempo_gpu_s < tiempo_cpu_s""",
}
