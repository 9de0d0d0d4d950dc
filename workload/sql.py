"""The same queries as SQL over the supplied tables, for a side-by-side check.

``VIEWS`` is one chain of common table expressions; a query names what it needs and the
rest of the chain is never evaluated.
"""

from __future__ import annotations

from workload import params as P


def _parse(column: str) -> str:
    t = f"trim({column})"
    return f"""CASE length({t})
        WHEN 10 THEN try_strptime({t} || '0000', '%Y%m%d%H%M%S')
        WHEN 14 THEN try_strptime({t}, '%Y%m%d%H%M%S')
        WHEN 19 THEN try_strptime({t}, '%Y-%m-%d %H:%M:%S') END"""


def _buckets(amount: str) -> str:
    return ", ".join(
        f"sum(CASE WHEN substr(trim(subentry_code), 1, 3) = '{code}' THEN {amount} ELSE 0 END) AS {name}"
        for name, code in P.SUBENTRY_BUCKETS.items()
    )


BUCKETS = list(P.SUBENTRY_BUCKETS)
SUM_BUCKETS = ", ".join(f"sum({c}) AS {c}" for c in [*BUCKETS, "rate"])


def _double(*columns: str) -> str:
    """Decimals as doubles; four places are more than any amount here has."""
    return ", ".join(f"CAST(CAST({c} AS DECIMAL(18,4)) AS DOUBLE) AS {c}" for c in columns)


def _rows(rows: list[tuple]) -> str:
    def cell(x):
        if x is None:
            return "NULL"
        return f"'{x}'" if isinstance(x, str) else str(x)

    return ", ".join("(" + ", ".join(cell(x) for x in r) + ")" for r in rows)


def _amounts(clean: str) -> str:
    """Amounts per series and hour over a relation of clean readings."""
    return f"""
        SELECT f.item_name, f.type_id, f.type, f.hour, f.n_readings,
               CAST(f.register AS DECIMAL(18,4)) * coalesce(l.coefficient, 1) AS amount,
               coalesce(l.max_value, 10000) AS max_value
        FROM (SELECT item_name, type_id, type, hour, register,
                     row_number() OVER (PARTITION BY item_name, type_id, hour ORDER BY reading_ts, pos) AS rn,
                     count(*) OVER (PARTITION BY item_name, type_id, hour) AS n_readings
              FROM {clean}) f
        LEFT JOIN limits l ON f.item_name = l.item_name AND f.type_id = l.type_id
        WHERE f.rn = 1"""


def _emit(amounts: str) -> str:
    return f"""
        SELECT item_name, type_id, prev_hour AS date_time,
               CASE WHEN amount - prev_amount > 0 THEN amount - prev_amount ELSE 0 END AS value,
               amount AS real_value, CAST(0 AS DECIMAL(18,4)) AS rate,
               CAST(CASE WHEN amount - prev_amount >= 0 AND amount - prev_amount < max_value
                    THEN 0 ELSE 2 END AS INTEGER) AS error, type
        FROM (SELECT *, lag(hour) OVER w AS prev_hour, lag(amount) OVER w AS prev_amount
              FROM ({amounts}) a
              WINDOW w AS (PARTITION BY item_name, type_id ORDER BY hour)) p
        WHERE hour = prev_hour + INTERVAL 1 HOUR"""


def _rollup(rows: str, unit: str) -> str:
    return f"""
        SELECT item_name, type_id, date_trunc('{unit}', date_time) AS date_time, type,
               sum(value) AS value, arg_max(real_value, date_time) AS real_value,
               sum(rate) AS rate, CAST(0 AS INTEGER) AS error
        FROM {rows} WHERE error = 0
        GROUP BY item_name, type_id, date_trunc('{unit}', date_time), type"""


def _subentry_hour(rows: str) -> str:
    return f"""
        SELECT split_part(h.item_name, '_', 1) AS building_code, {_buckets('h.value')},
               CAST(0 AS DECIMAL(18,4)) AS rate, h.date_time AS data_time
        FROM {rows} h JOIN subentries s ON h.item_name = s.item_name
        WHERE h.error = 0 AND h.type = 'A' GROUP BY 1, h.date_time"""


def _virtual(hours: str, due: str = "due") -> str:
    """The workload's formulas written out; missing inputs are 0.

    A bare number in a formula is an item id, so the ``( 2 )`` of V1 is a missing input.
    """
    def inputs(kind: int, x1: int, x2: int) -> str:
        name = "'B%d_G%d_M%d'"
        n1, n2 = name % (x1 % 5, x1 % 2, x1), name % (x2 % 5, x2 % 2, x2)
        picked = []
        for metric in ("value", "real_value", "rate"):
            for tag, n in (("a", n1), ("b", n2)):
                picked.append(f"coalesce(max({metric}) FILTER (item_name = {n}), 0) AS {metric}_{tag}")
        return f"""SELECT date_time, {', '.join(picked)} FROM {hours}
                   WHERE error = 0 AND type_id = {kind} AND item_name IN ({n1}, {n2}) GROUP BY date_time"""

    def row(name: str, kind: int, basic: str, top: int, expressions: list[str], source: str) -> str:
        v, r, q = expressions
        return f"""
        SELECT 'B0_G0_{name}' AS item_name, CAST({kind} AS INTEGER) AS type_id, i.date_time,
               CASE WHEN {v} > 0 THEN {v} ELSE 0 END AS value, {r} AS real_value, {q} AS rate,
               CAST(CASE WHEN {v} >= 0 AND {v} <= {top} THEN 0 ELSE 2 END AS INTEGER) AS error,
               '{basic}' AS type
        FROM ({source}) i JOIN {due} d ON i.date_time = d.date_time"""

    def over(template: str) -> list[str]:
        return ["(" + template.format(a=f"{m}_a", b=f"{m}_b") + ")" for m in ("value", "real_value", "rate")]

    return " UNION ALL ".join([
        row("V1", 11, "A", 100, over("{a} + {b} - 5 * 0"), inputs(11, 0, 1)),
        row("V2", 11, "A", 10000, ["CAST(0 AS DECIMAL(18,4))"] * 3, inputs(11, 0, 1)),
        row("V5", 11, "A", 10000, over("({a} + {b}) * 2 - 1"), inputs(11, 0, 1)),
        row("V3", 12, "B", 10000, over("{a} + {b}"), inputs(12, 0, 1)),
    ])


def _pending_third(upto: str) -> str:
    """Third-party reports up to a stamp that are not done."""
    return f"""
        SELECT DISTINCT build_code, collector_code, "timestamp" FROM queue q
        WHERE type = 2 AND "timestamp" <= {upto} AND NOT EXISTS (
            SELECT 1 FROM queue d WHERE d.type = 3 AND d.build_code = q.build_code
              AND d.collector_code = q.collector_code AND d."timestamp" = q."timestamp")"""


def _third_amounts(reports: str) -> str:
    return f"""
        SELECT building_code, {_buckets('counted')}, CAST(0 AS DECIMAL(18,4)) AS rate, data_time
        FROM (SELECT split_part(h.item_name, '_', 1) AS building_code, h.date_time AS data_time,
                     s.subentry_code, CASE WHEN h.value < 100000 THEN h.value ELSE 0 END AS counted
              FROM hourly h
              JOIN {reports} p ON split_part(h.item_name, '_', 1) = p.build_code
               AND split_part(h.item_name, '_', 2) = p.collector_code
               AND h.date_time = strptime(p."timestamp" || '0000', '%Y%m%d%H%M%S')
              LEFT JOIN subentries s ON h.item_name = s.item_name
              WHERE h.type = 'A') c
        GROUP BY building_code, data_time"""


def _resumed(name: str, recorded: list[tuple]) -> str:
    return f"""
        SELECT l.event_id, l.partition, l."offset", '{name}' AS recorded,
               CAST((l."offset" - s.start) // {P.PER_BATCH} AS BIGINT) AS batch
        FROM log l JOIN (
            SELECT b.partition, CASE WHEN (SELECT bool_or(r.seen > 0 AND r.seen < c.beginning)
                FROM log_beginnings c JOIN (VALUES {_rows(recorded)}) r(partition, seen)
                  ON c.partition = r.partition)
              THEN b.beginning ELSE greatest(coalesce(r.seen, 0), b.beginning) END AS start
            FROM log_beginnings b LEFT JOIN (VALUES {_rows(recorded)}) r(partition, seen)
              ON b.partition = r.partition) s ON l.partition = s.partition
        WHERE l."offset" >= s.start"""


def _round_modes() -> str:
    """On whole ten-thousandths: a is their number, q the hundredths in it, r the rest."""
    rules = {
        "up": "r > 0", "down": "false", "ceiling": "r > 0 AND s > 0", "floor": "r > 0 AND s < 0",
        "half_up": "r >= 50", "half_down": "r > 50", "half_even": "r > 50 OR (r = 50 AND q % 2 = 1)",
    }
    made = ", ".join(
        f"CAST(s * (q + CASE WHEN {rule} THEN 1 ELSE 0 END) AS DOUBLE) / 100 AS {mode}"
        for mode, rule in rules.items()
    )
    return f"""SELECT l_orderkey, l_linenumber, l_partkey, {made} FROM (
        SELECT *, a // 100 AS q, a % 100 AS r FROM (
        SELECT *, abs(n) AS a, CASE WHEN n < 0 THEN -1 ELSE 1 END AS s FROM (
        SELECT *, CAST(round((CAST(l_extendedprice AS DECIMAL(12,2)) * 0.005
               - CAST(l_quantity AS DECIMAL(12,2)) * 5) * 10000, 0) AS BIGINT) AS n FROM (
        SELECT * FROM lineitem))))"""


def _due(readings: str) -> str:
    """Hours for which the virtual items of the first collector are due."""
    return f"""
        SELECT DISTINCT date_trunc('hour', reading_ts) - INTERVAL 1 HOUR AS date_time
        FROM typed WHERE building_id = 'B0' AND gate_id = 'G0' AND {readings}"""


def _derived(prefix: str, virtual_rows: str) -> dict[str, str]:
    """Tables over own and virtual hour rows."""
    rows = f"{prefix}_hourly"
    return {
        rows: f"SELECT * FROM hourly UNION ALL SELECT * FROM {virtual_rows}",
        f"{prefix}_day": _rollup(rows, "day"),
        f"{prefix}_month": _rollup(f"{prefix}_day", "month"),
        f"{prefix}_subentry": _subentry_hour(rows),
    }


STORABLE = f"(coalesce(reading_ts <= TIMESTAMP '{P.NOW}', FALSE) AND register IS NOT NULL)"
SEED_AMOUNTS = _amounts(f"(SELECT * FROM clean WHERE reading_ts < TIMESTAMP '{P.SPLIT}') c")

VIEWS = {
    "e": """SELECT event_id, ts, user_id, event_type, user_id % 10 AS x,
                   CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
                   CAST(value AS DECIMAL(18,2)) AS d FROM events""",
    "g": """SELECT *, CASE WHEN event_type = 'view' THEN CAST(d AS DECIMAL(28,2))
                   ELSE CAST(sum(d) OVER (PARTITION BY x, event_type ORDER BY ts, event_id
                        ROWS UNBOUNDED PRECEDING) AS DECIMAL(28,2)) END AS reg FROM e""",
    "media": f"SELECT * FROM (VALUES {_rows(P.MEDIA)}) m(event_type, id, code, basic_code, table_name)",
    "readings": """
        SELECT event_id, concat('B', user_id % 5) AS building_id, concat('G', user_id % 2) AS gate_id,
               concat('M', x) AS meter_id, coalesce(m.code, '99-9') AS param_id, '01' AS type,
               CAST(NULL AS VARCHAR) AS name,
               CASE WHEN k % 10 = 0 THEN '1' ELSE '0' END AS status,
               CASE WHEN k = 7 THEN '48,892.60' WHEN k = 17 THEN NULL WHEN k = 27 THEN 'NaN'
                    ELSE CAST(reg AS VARCHAR) END AS value,
               'kWh' AS unit,
               CASE WHEN k = 37 THEN '20171009131B00' WHEN k = 47 THEN NULL
                    WHEN k % 3 = 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
                    ELSE strftime(ts, '%Y%m%d%H%M%S') END AS ts_str
        FROM g LEFT JOIN media m ON g.event_type = m.event_type""",
    "typed": f"""
        SELECT *, {_parse('ts_str')} AS reading_ts, TRY_CAST(value AS DECIMAL(20,6)) AS register
        FROM readings""",
    "clean": f"""
        SELECT concat_ws('_', building_id, gate_id, meter_id) AS item_name,
               CAST(m.id AS INTEGER) AS type_id, m.basic_code AS type, reading_ts,
               date_trunc('hour', reading_ts) AS hour, register, trim(status) AS status, event_id AS pos
        FROM typed t JOIN media m ON t.param_id = m.code
        WHERE trim(status) = '0' AND register IS NOT NULL
          AND reading_ts <= TIMESTAMP '{P.NOW}' + INTERVAL 1 HOUR""",
    "seen": "SELECT DISTINCT x, event_type FROM e",
    "buildings": "SELECT DISTINCT x % 5 + 1 AS id, concat('B', x % 5) AS code FROM seen",
    "collectors": """SELECT DISTINCT x + 1 AS id, concat('G', x % 2) AS code, x % 5 + 1 AS building_id
                     FROM seen""",
    "virtuals": f"""SELECT * FROM (VALUES {_rows(P.VIRTUALS)})
                    v(id, code, data_type, max_value, subentry, formula)""",
    "items": """
        SELECT 1000 + 4 * x + (m.id - 11) AS id, concat('M', x) AS code, x + 1 AS collector_id,
               m.id AS data_type,
               CASE x WHEN 0 THEN NULL WHEN 1 THEN -1 WHEN 2 THEN 50 ELSE 100 END AS max_value,
               CASE x WHEN 3 THEN NULL WHEN 4 THEN -1 WHEN 5 THEN 2 ELSE 1 END AS coefficient,
               CASE WHEN m.id = 11 THEN x % 6 + 1 END AS subentry
        FROM seen JOIN media m ON seen.event_type = m.event_type
        UNION ALL
        SELECT id, code, 1, data_type, max_value, NULL, subentry FROM virtuals""",
    "placed": """
        SELECT i.*, concat_ws('_', b.code, c.code, i.code) AS item_name, b.code AS building_code,
               c.code AS collector_code
        FROM items i JOIN collectors c ON i.collector_id = c.id JOIN buildings b ON c.building_id = b.id""",
    "limits": """
        SELECT item_name, data_type AS type_id,
               CASE WHEN max_value >= 0 THEN max_value ELSE 10000 END AS max_value,
               CASE WHEN coefficient >= 0 THEN coefficient ELSE 1 END AS coefficient FROM placed""",
    "subentry_codes": f"""SELECT * FROM (VALUES {_rows(list(enumerate(P.SUBENTRY_CODES, 1)))}) s(id, code)""",
    "subentries": """SELECT item_name, s.code AS subentry_code FROM placed
                     JOIN subentry_codes s ON placed.subentry = s.id WHERE data_type = 11""",
    "amounts": _amounts("clean"),
    "hourly": _emit("SELECT * FROM amounts"),
    "elec_day": _rollup("(SELECT * FROM hourly WHERE type = 'A') h", "day"),
    "other_day": _rollup("(SELECT * FROM hourly WHERE type IS DISTINCT FROM 'A') h", "day"),
    "subentry_hourly": _subentry_hour("hourly"),
    "own_queue": f"""
        SELECT DISTINCT building_id AS build_code, gate_id AS collector_code,
               strftime(reading_ts, '%Y%m%d%H') AS "timestamp", CAST(0 AS INTEGER) AS type
        FROM typed WHERE reading_ts <= TIMESTAMP '{P.NOW}' + INTERVAL 1 HOUR""",
    "queue": """
        SELECT * FROM own_queue UNION ALL
        SELECT DISTINCT concat('B', user_id % 5), concat('G', user_id % 2), strftime(ts, '%Y%m%d%H'),
               CAST(CASE event_type WHEN 'signup' THEN 2 ELSE 3 END AS INTEGER)
        FROM e WHERE event_type IN ('signup', 'error')""",
    "pending_third": _pending_third(f"'{P.QUEUE_STAMP}'"),
    "third_amounts": _third_amounts("pending_third"),
    # In the live job a report is due once a reading has been queued for its hour or a later one.
    "live_marks": _pending_third('(SELECT max("timestamp") FROM own_queue)'),
    "live_third": _third_amounts("live_marks"),
    "due": _due("reading_ts <= TIMESTAMP '%s' + INTERVAL 1 HOUR" % P.NOW),
    # A backfill sees the stored history only, which has no quarantined records.
    "history_due": _due(STORABLE),
    "virtual_hourly": _virtual("hourly"),
    "early_virtual": _virtual("(SELECT * FROM hourly WHERE split_part(item_name, '_', 1) = 'B0')"),
    "history_virtual": _virtual("hourly", "history_due"),
    **_derived("all", "virtual_hourly"),
    **_derived("history", "history_virtual"),
    "live_hourly": "SELECT * FROM all_hourly",
    "live_day": "SELECT * FROM all_day",
    "live_month": "SELECT * FROM all_month",
    "live_subentry": f"""
        SELECT building_code, {SUM_BUCKETS}, data_time
        FROM (SELECT * FROM all_subentry UNION ALL BY NAME SELECT * FROM live_third) b
        GROUP BY building_code, data_time""",
    "log_rows": """
        SELECT event_id, CAST(x % 4 AS INTEGER) AS partition,
               row_number() OVER (PARTITION BY x % 4 ORDER BY event_id) - 1 AS "offset",
               count(*) OVER (PARTITION BY x % 4) // 10 AS kept_from FROM e""",
    "log": 'SELECT event_id, partition, "offset" FROM log_rows WHERE "offset" >= kept_from',
    "log_beginnings": 'SELECT partition, min("offset") AS beginning FROM log GROUP BY partition',
    "seeds": f"""
        SELECT item_name, type_id, max(hour) AS seed_hour FROM ({SEED_AMOUNTS}) s GROUP BY 1, 2""",
    # The catalogue: nations, suppliers and the parts each supplies.
    "cat_items": """
        SELECT l_suppkey * 10000000000 + l_partkey AS id, CAST(l_partkey AS VARCHAR) AS code,
               l_suppkey AS collector_id, CAST(11 + p_size % 4 AS INTEGER) AS data_type,
               CASE WHEN p_size = 1 THEN NULL WHEN p_size = 2 THEN -1 ELSE p_retailprice END AS max_value,
               CASE WHEN p_size = 3 THEN NULL WHEN p_size = 4 THEN -1 ELSE p_size END AS coefficient,
               p_size % 7 + 1 AS subentry, p_type
        FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) JOIN part ON l_partkey = p_partkey""",
    "cat_placed": """
        SELECT i.*, concat_ws('_', n_name, s_name, i.code) AS item_name, n_name AS building_code,
               s_name AS collector_code
        FROM cat_items i JOIN supplier ON i.collector_id = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey""",
}


def _nested() -> dict[str, str]:
    """Levels and cycles of the nested formulas by recursion, then the rows level by level."""
    views = {
        "nested_defs": f"""
            SELECT n.id, concat_ws('_', b.code, c.code, n.code) AS item_name, n.type_id, n.top,
                   b.code AS building_code, c.code AS collector_code, m.basic_code AS type,
                   coalesce(a.added, 0) AS added
            FROM (VALUES {_rows([n[:5] for n in P.NESTED])}) n(id, code, collector_id, type_id, top)
            JOIN collectors c ON n.collector_id = c.id JOIN buildings b ON c.building_id = b.id
            JOIN media m ON n.type_id = m.id
            LEFT JOIN (VALUES {_rows(P.NESTED_ADDED)}) a(id, added) ON n.id = a.id""",
        "nested_terms": f"""
            SELECT t.id, t.source, t.factor, d.type_id
            FROM (VALUES {_rows(P.NESTED_TERMS)}) t(id, source, factor) JOIN nested_defs d ON t.id = d.id""",
        "nested_sources": """
            SELECT id, item_name, data_type AS type_id FROM placed
            WHERE id NOT IN (SELECT id FROM virtuals)
            UNION ALL SELECT id, item_name, type_id FROM nested_defs""",
        "nested_edges": """
            SELECT t.id, t.source FROM nested_terms t JOIN nested_defs s ON t.source = s.id
            WHERE (t.type_id = 11) = (s.type_id = 11)""",
        "nested_reach": """
            SELECT id, source FROM nested_edges
            UNION SELECT r.id, e.source FROM nested_reach r JOIN nested_edges e ON r.source = e.id""",
        "nested_cycles": "SELECT DISTINCT id FROM nested_reach WHERE id = source",
        "nested_depths": """
            SELECT id, 0 AS level FROM nested_defs WHERE id NOT IN (SELECT id FROM nested_cycles)
            UNION SELECT e.id, d.level + 1 FROM nested_depths d JOIN nested_edges e ON e.source = d.id
            WHERE e.id NOT IN (SELECT id FROM nested_cycles)""",
        "nested_levels": "SELECT id, max(level) AS level FROM nested_depths GROUP BY id",
    }
    known = "SELECT * FROM hourly"
    for level in range(P.NESTED_LEVELS):
        sums = ", ".join(
            f"sum(t.factor * h.{m}) + any_value(d.added) AS {m}" for m in ("value", "real_value", "rate")
        )
        views[f"nested_{level}"] = f"""
            SELECT s.item_name, CAST(s.type_id AS INTEGER) AS type_id, s.date_time,
                   CASE WHEN s.value > 0 THEN s.value ELSE 0 END AS value, s.real_value, s.rate,
                   CAST(CASE WHEN s.value >= 0 AND s.value <= coalesce(s.top, 10000) THEN 0 ELSE 2 END
                        AS INTEGER) AS error, s.type
            FROM (SELECT d.item_name, d.type_id, d.type, d.top, d.building_code, d.collector_code,
                         h.date_time, {sums}
                  FROM nested_levels l JOIN nested_defs d ON l.id = d.id
                  JOIN nested_terms t ON t.id = d.id JOIN nested_sources n ON t.source = n.id
                  JOIN ({known}) h ON h.item_name = n.item_name AND h.type_id = n.type_id
                  WHERE l.level = {level} AND h.error = 0 AND (h.type = 'A') = (d.type = 'A')
                  GROUP BY ALL) s
            JOIN own_queue q ON q.build_code = s.building_code AND q.collector_code = s.collector_code
             AND strptime(q."timestamp" || '0000', '%Y%m%d%H%M%S') - INTERVAL 1 HOUR = s.date_time"""
        known += f" UNION ALL SELECT * FROM nested_{level}"
    return views


NESTED_VIEWS = _nested()
PREFIX = "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in VIEWS.items()) + "\n"

HOUR = f"item_name, type_id, date_time, {_double('value', 'real_value', 'rate')}, error, type"
DAY = HOUR + ", CAST(0 AS DOUBLE) AS work_time_value, CAST(0 AS DOUBLE) AS other_time_value"
SUBENTRY = f"building_code, {_double(*BUCKETS, 'rate')}, data_time"
READING = "building_id, gate_id, meter_id, param_id, type, name, status, value, unit, ts_str"

_ANCHORS = {
    "current_minute": "date_trunc('minute', ts)",
    "current_hour": "date_trunc('hour', ts)",
    "last_hour": "date_trunc('hour', ts) - INTERVAL 1 HOUR",
    "last_two_hour": "date_trunc('hour', ts) - INTERVAL 2 HOUR",
    "next_hour": "date_trunc('hour', ts) + INTERVAL 1 HOUR",
    "current_day": "CAST(date_trunc('day', ts) AS TIMESTAMP)",
    "last_day": "CAST(date_trunc('day', ts) AS TIMESTAMP) - INTERVAL 1 DAY",
    "next_day": "CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 1 DAY",
    "current_month": "CAST(date_trunc('month', ts) AS TIMESTAMP)",
    "last_month": "CAST(date_trunc('month', ts) AS TIMESTAMP) - INTERVAL 1 MONTH",
    "next_month": "CAST(date_trunc('month', ts) AS TIMESTAMP) + INTERVAL 1 MONTH",
}


def _type_counts() -> str:
    tests = {
        "value": ("decimal", "TRY_CAST(value AS DECIMAL(38,10)) IS NOT NULL"),
        "status": ("int", "TRY_CAST(status AS INTEGER) IS NOT NULL"),
        "ts_str": ("bigint", "TRY_CAST(ts_str AS BIGINT) IS NOT NULL"),
        "unit": ("bit", "lower(unit) IN ('true', 'false')"),
        "name": ("string", "TRUE"),
        "meter_id": ("varchar", "FALSE"),
    }
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, '{t}' AS declared_type, count(*) AS n_rows,
                   count(*) FILTER ({test}) AS n_ok FROM readings"""
        for c, (t, test) in tests.items()
    )


def _stored_type(column: str) -> str:
    cases = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in P.STORED_TYPES.items())
    return f"CASE {column} {cases} ELSE upper({column}) END"


def _pipeline(prefix: str, with_state: bool = True) -> str:
    def energy(name: str, rows: str) -> str:
        return f"""SELECT '{name}' AS table_name, item_name AS code, CAST(type_id AS VARCHAR) AS part,
                   date_time, {_double('value')}, {_double('real_value')}, error FROM {rows} r"""

    def buckets(name: str, rows: str) -> str:
        return " UNION ALL ".join(
            f"""SELECT '{name}', building_code, '{b}', data_time,
                CAST(CAST({b} AS DECIMAL(18,4)) AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS INTEGER)
                FROM {rows} r""" for b in BUCKETS
        )

    day_buckets = f"""(SELECT building_code, {SUM_BUCKETS}, date_trunc('day', data_time) AS data_time
                       FROM {prefix}_subentry GROUP BY building_code, date_trunc('day', data_time))"""
    state = f"""SELECT 'state', item_name, CAST(type_id AS VARCHAR), max(hour),
                CAST(CAST(arg_max(amount, hour) AS DECIMAL(18,4)) AS DOUBLE), CAST(0 AS DOUBLE),
                CAST(0 AS INTEGER) FROM amounts GROUP BY item_name, type_id"""
    return " UNION ALL ".join([
        energy("hour", f"{prefix}_hourly"), energy("day", f"{prefix}_day"),
        energy("month", f"{prefix}_month"), buckets("subentry_hour", f"{prefix}_subentry"),
        buckets("subentry_day", day_buckets), *[state] * with_state,
    ])


_LAST_ORDER = f"""
    SELECT o_custkey + {P.KEY_SHIFT} AS key,
           CAST(arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS DECIMAL(18,2)) AS amount,
           arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS tag
    FROM orders GROUP BY o_custkey"""
_FLAGS = """SELECT l_orderkey AS key, CASE min(l_linestatus) WHEN 'F' THEN 'F' ELSE 'O' END AS expected,
            max(l_returnflag) AS value FROM lineitem GROUP BY l_orderkey"""

_QUERIES = {
    # sources
    "decode_readings": f"""SELECT event_id, {', '.join(
        f"CASE WHEN status = '0' THEN {c} END AS {c}" for c in READING.split(', '))} FROM readings""",
    "history_range_scan": f"""SELECT event_id, {READING} FROM typed
        WHERE reading_ts >= TIMESTAMP '{P.FROM}' AND reading_ts < TIMESTAMP '{P.TO}'""",
    "energy_scan_point": f"SELECT {HOUR} FROM hourly WHERE date_time = TIMESTAMP '{P.POINT}'",
    "energy_scan_range": f"""SELECT {HOUR} FROM hourly WHERE date_time >= TIMESTAMP '{P.FROM}'
        AND date_time < TIMESTAMP '{P.TO}' AND item_name = '{P.ITEM}'""",
    "scan_project_filter": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        WHERE o_orderstatus = 'F' AND o_totalprice > 100000""",
    "key_range_regex_scan": f"""SELECT c_name, concat_ws(',', CAST(c_custkey AS VARCHAR), c_mktsegment,
        CAST(c_nationkey AS VARCHAR)) AS cells FROM customer
        WHERE c_name BETWEEN '{P.KEY_FROM}' AND '{P.KEY_TO}' AND regexp_matches(c_name, '[05]$')
          AND regexp_matches(c_name, '^Customer#')""",
    "column_range_scan": """SELECT s_name, concat_ws(',', s_name, CAST(s_nationkey AS VARCHAR)) AS cells
        FROM supplier WHERE s_nationkey BETWEEN 3 AND 12 AND regexp_matches(s_name, '[0-4]$')""",
    "indexed_lookup": f"""SELECT o_custkey, o_orderkey, o_orderstatus, 'keys' AS lookup FROM orders
        WHERE o_custkey IN ({', '.join(map(str, P.CUSTOMERS))}) UNION ALL
        SELECT o_custkey, o_orderkey, o_orderstatus, 'range' FROM orders
        WHERE o_custkey BETWEEN {P.CUSTOMER_RANGE[0]} AND {P.CUSTOMER_RANGE[1]}""",
    "row_count": "SELECT count(*) AS n_rows FROM lineitem",
    # scalar functions
    "valid_time": f"""SELECT event_id,
        coalesce(reading_ts <= TIMESTAMP '{P.SPLIT}', FALSE) AS valid_strict,
        coalesce(reading_ts <= TIMESTAMP '{P.SPLIT}' + INTERVAL 1 HOUR, FALSE) AS valid_tolerant FROM typed""",
    "valid_number": "SELECT event_id, register IS NOT NULL AS valid FROM typed",
    "time_normalize": """SELECT event_id, strftime(date_trunc('hour', reading_ts), '%Y%m%d%H%M%S') AS hour_text,
        strftime(reading_ts, '%Y-%m-%d %H:%M:%S') AS dashed,
        CAST(epoch(reading_ts) AS BIGINT) AS epoch_seconds FROM typed""",
    "calendar_anchors": "SELECT event_id, " + ", ".join(f"{x} AS {n}" for n, x in _ANCHORS.items()) + " FROM e",
    "decimal_arith": """SELECT l_orderkey, l_linenumber, l_partkey,
        CAST(CAST(l_extendedprice AS DECIMAL(18,2)) + CAST(l_tax AS DECIMAL(18,2)) AS DOUBLE) AS total,
        CAST(CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(l_discount AS DECIMAL(18,2)) AS DOUBLE) AS rest,
        CAST(CAST(l_quantity AS DECIMAL(9,2)) * CAST(l_discount AS DECIMAL(9,2)) AS DOUBLE) AS product
        FROM lineitem""",
    "date_helpers": """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS text,
        o_orderdate AS parsed, CAST(NULL AS TIMESTAMP) AS unparsable,
        o_orderdate + INTERVAL 1 MONTH AS next_month, o_orderdate - INTERVAL 13 MONTH AS back_13,
        o_orderdate + INTERVAL 1 YEAR AS next_year FROM orders""",
    "tz_display": """SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS local_text FROM e""",
    "string_keys": r"""SELECT event_id, concat_ws('_', building_id, gate_id, meter_id) AS item_name,
        building_id AS building, gate_id AS collector, concat_ws('_', building_id, gate_id) AS collector_code,
        regexp_replace(ts_str, '\D', '', 'g') AS digits, substr(ts_str, 1, 10) AS first10,
        substr(trim(param_id), 1, 3) AS prefix3, replace(param_id, '-', '#') AS swapped,
        regexp_full_match(param_id, '[0-9]*') AS all_digits, starts_with(meter_id, 'd') AS is_constant,
        concat_ws('|', building_id, gate_id, meter_id) AS parts FROM readings""",
    "sort_points": """SELECT o_orderkey, array_to_string(list_transform(list_sort([
          {'n': o_orderkey, 'i': 0, 'name': concat('dp', o_orderkey)},
          {'n': o_custkey, 'i': 1, 'name': concat('dp', o_custkey)},
          {'n': CAST(day(o_orderdate) AS BIGINT), 'i': 2, 'name': concat('dp', day(o_orderdate))}]),
          lambda p: p.name), ',') AS points FROM orders""",
    # cleaning
    "clean_readings": """SELECT item_name, type_id, type, reading_ts, hour,
        CAST(register AS DOUBLE) AS register, status, pos FROM clean""",
    "quarantine_split": f"SELECT event_id, {READING}, NOT {STORABLE} AS quarantined FROM typed",
    "route_by_medium": f"""SELECT {HOUR}, CASE WHEN type = 'A' THEN 'elec' ELSE 'other' END AS medium FROM hourly""",
    # dimensions
    "item_limits": """SELECT item_name, data_type AS type_id,
        CAST(CASE WHEN max_value >= 0 THEN max_value ELSE 10000 END AS DOUBLE) AS max_value,
        CAST(CASE WHEN coefficient >= 0 THEN coefficient ELSE 1 END AS DOUBLE) AS coefficient FROM cat_placed""",
    "item_codes": "SELECT id AS item_id, item_name, data_type AS type_id FROM cat_placed",
    "subentry_map": """SELECT item_name, building_code, s.code AS subentry_code FROM cat_placed
        JOIN subentry_codes s ON cat_placed.subentry = s.id WHERE data_type = 11""",
    "virtual_items": """SELECT item_name, building_code, collector_code, p.code AS item_code,
        concat(p.id, ' + d1') AS formula, CAST(max_value AS DOUBLE) AS max_value, data_type AS type_id,
        m.code AS type_code, m.table_name, m.basic_code AS type
        FROM cat_placed p JOIN media m ON p.data_type = m.id WHERE p_type = 'PROMO'""",
    # hourly
    "hourly_consumption": f"SELECT {HOUR} FROM hourly",
    "hourly_selfjoin": f"SELECT {HOUR} FROM hourly",
    "hourly_with_state": f"""SELECT {HOUR} FROM hourly LEFT JOIN seeds USING (item_name, type_id)
        WHERE seed_hour IS NULL OR date_time >= seed_hour""",
    "hourly_gap_class": """SELECT item_name, type_id, hour,
        CASE WHEN prev IS NULL THEN 'first' WHEN hour = prev + INTERVAL 1 HOUR THEN 'consecutive'
             ELSE 'gap' END AS gap_class,
        CAST((epoch(hour) - epoch(prev)) / 3600 AS BIGINT) AS gap_hours, n_readings - 1 AS n_ignored
        FROM (SELECT *, lag(hour) OVER (PARTITION BY item_name, type_id ORDER BY hour) AS prev FROM amounts) a""",
    "current_info": f"""SELECT item_name, type_id, max(hour) AS date_time,
        CAST(CAST(arg_max(amount, hour) AS DECIMAL(18,4)) AS DOUBLE) AS real_value, '0' AS status
        FROM amounts GROUP BY item_name, type_id""",
    # rollups
    "day_rollup_elec": f"SELECT {DAY} FROM elec_day",
    "day_rollup_other": f"SELECT {DAY} FROM other_day",
    "month_rollup_elec": f"SELECT {HOUR} FROM ({_rollup('elec_day', 'month')}) m",
    "month_rollup_other": f"SELECT {HOUR} FROM ({_rollup('other_day', 'month')}) m",
    "day_rollup_incremental": f"SELECT {DAY} FROM ({_rollup('hourly', 'day')}) d",
    "subentry_hour": f"SELECT {SUBENTRY} FROM subentry_hourly",
    "subentry_day": f"""SELECT {SUBENTRY} FROM (
        SELECT building_code, {SUM_BUCKETS}, date_trunc('day', data_time) AS data_time
        FROM subentry_hourly GROUP BY building_code, date_trunc('day', data_time)) d""",
    "third_party_subentry": f"""SELECT {SUBENTRY} FROM (
        SELECT building_code, {SUM_BUCKETS}, data_time
        FROM (SELECT * FROM subentry_hourly UNION ALL BY NAME SELECT * FROM third_amounts) b
        GROUP BY building_code, data_time) s""",
    "third_party_subentry_day": f"""SELECT {SUBENTRY} FROM (
        SELECT building_code, {SUM_BUCKETS}, date_trunc('day', data_time) AS data_time
        FROM (SELECT * FROM subentry_hourly UNION ALL BY NAME SELECT * FROM third_amounts) b
        GROUP BY building_code, date_trunc('day', data_time)) s""",
    # virtual meters
    "virtual_meter_hour": f"SELECT {HOUR} FROM virtual_hourly",
    "virtual_change": f"""SELECT {HOUR}, is_new, {_double('change_value', 'change_real_value', 'change_rate')}
        FROM (SELECT v.*, p.item_name IS NULL AS is_new, v.value - coalesce(p.value, 0) AS change_value,
                     v.real_value - coalesce(p.real_value, 0) AS change_real_value,
                     v.rate - coalesce(p.rate, 0) AS change_rate
              FROM virtual_hourly v LEFT JOIN early_virtual p
                ON v.item_name = p.item_name AND v.type_id = p.type_id AND v.date_time = p.date_time) c
        WHERE is_new OR change_value <> 0""",
    "virtual_day_rollup": f"SELECT {DAY} FROM all_day",
    "virtual_nested": "WITH RECURSIVE " + ", ".join(f"{n} AS ({b})" for n, b in NESTED_VIEWS.items())
        + " UNION ALL ".join(f" SELECT {HOUR} FROM nested_{n}" for n in range(P.NESTED_LEVELS)),
    # queue
    "data_access_events": "SELECT * FROM own_queue",
    "queue_pending": f"""SELECT build_code, collector_code, "timestamp" FROM own_queue
        WHERE "timestamp" <= '{P.QUEUE_STAMP}' ORDER BY "timestamp" """,
    "queue_pending_third_party": "SELECT * FROM pending_third",
    "queue_mark": f"""SELECT build_code, collector_code, "timestamp",
        CAST(CASE WHEN type = 2 AND "timestamp" <= '{P.QUEUE_STAMP}' THEN 3 ELSE type END AS INTEGER) AS type
        FROM queue""",
    "queue_purge": f"""SELECT * FROM queue WHERE NOT (type = 0 AND "timestamp" <= '{P.QUEUE_STAMP}')
        AND NOT (type = 2 AND "timestamp" = '{P.QUEUE_STAMP}')""",
    # table changes
    "upsert_replace": f"""WITH s AS ({_LAST_ORDER}) SELECT key, CAST(amount AS DOUBLE) AS amount, tag FROM s
        UNION ALL SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE), c_mktsegment
        FROM customer WHERE c_custkey NOT IN (SELECT key FROM s)""",
    "upsert_add": """SELECT key, CAST(sum(amount) AS DOUBLE) AS amount FROM (
        SELECT o_orderkey AS key, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders UNION ALL
        SELECT l_orderkey, CAST(l_extendedprice AS DECIMAL(18,2)) FROM lineitem) b GROUP BY key""",
    "insert_if_absent": """SELECT c_custkey AS key, c_name AS name FROM customer UNION ALL
        SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT c_custkey FROM customer)""",
    "conditional_update": f"""WITH s AS ({_FLAGS}) SELECT o_orderkey AS key, o_orderstatus,
        CASE WHEN o_orderstatus = expected THEN value ELSE o_orderpriority END AS o_orderpriority
        FROM orders LEFT JOIN s ON o_orderkey = key""",
    "conditional_delete": f"""WITH s AS ({_FLAGS}) SELECT o_orderkey AS key,
        CASE WHEN o_orderstatus = expected THEN NULL ELSE o_orderstatus END AS o_orderstatus, o_orderpriority
        FROM orders LEFT JOIN s ON o_orderkey = key""",
    "counter_increment": """SELECT key, CAST(sum(n) AS BIGINT) AS n FROM (
        SELECT c_custkey AS key, CAST(c_nationkey AS BIGINT) AS n FROM customer UNION ALL
        SELECT o_custkey, 1 FROM orders) b GROUP BY key""",
    "append_value": """SELECT c_custkey AS key, concat(c_mktsegment, coalesce(tail, '')) AS text FROM customer
        LEFT JOIN (SELECT o_custkey, max(o_orderpriority) AS tail FROM orders GROUP BY o_custkey) t
          ON c_custkey = o_custkey""",
    "delete_by_keys": """SELECT o_orderkey AS key, o_orderstatus, o_orderpriority FROM orders
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
    "null_sentinel": """SELECT event_id, coalesce(name, '-1000') AS name, coalesce(value, '-1000') AS value,
        coalesce(ts_str, '-1000') AS ts_str FROM readings""",
    "assign_ids": """WITH r AS (SELECT DISTINCT o_custkey, o_orderpriority FROM orders),
        s AS (SELECT c_custkey AS o_custkey, '5-LOW' AS o_orderpriority, c_custkey + 1 AS id FROM customer)
        SELECT id, o_custkey, o_orderpriority FROM r JOIN s USING (o_custkey, o_orderpriority) UNION ALL
        SELECT (SELECT max(id) FROM s) + row_number() OVER (ORDER BY o_custkey, o_orderpriority),
               o_custkey, o_orderpriority FROM r
        WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_custkey = r.o_custkey
                          AND s.o_orderpriority = r.o_orderpriority)""",
    "cast_by_spec": """SELECT o_orderkey, TRY_CAST(o_custkey AS TINYINT)::SMALLINT AS o_custkey,
        CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS o_totalprice, o_orderdate,
        o_orderstatus = 'F' AS o_orderstatus, o_orderpriority FROM orders""",
    "type_check": _type_counts(),
    "schema_from_spec": f"""SELECT p_partkey, CAST(position AS INTEGER) AS position, column_name, declared_type,
        {_stored_type('declared_type')} AS stored_type, column_name = 'id' AS is_key
        FROM (SELECT p_partkey, unnest([1, 2, 3]) AS position,
                     unnest(['id', lower(p_type), 'taken_at']) AS column_name,
                     unnest(['int', CASE WHEN p_size > 25 THEN 'money' ELSE 'nvarchar' END, 'datetime'])
                       AS declared_type FROM part) c""",
    "round_modes": _round_modes(),
    "stream_offsets": _resumed("valid", P.VALID_OFFSETS) + " UNION ALL " + _resumed("aged", P.AGED_OFFSETS),
    # streams and jobs
    "stream_ingest": f"SELECT {READING}, NOT {STORABLE} AS quarantined FROM typed",
    "stream_hourly": f"SELECT {HOUR} FROM hourly",
    "stream_hourly_fold": f"SELECT {HOUR} FROM hourly",
    "pipeline_live": _pipeline("live") + """
        UNION ALL SELECT 'marks', concat_ws('_', build_code, collector_code), "timestamp",
        strptime("timestamp" || '0000', '%Y%m%d%H%M%S'), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE),
        CAST(0 AS INTEGER) FROM live_marks""",
    "state_changelog": """SELECT item_name, type_id, max(hour) AS date_time,
        CAST(CAST(arg_max(amount, hour) AS DECIMAL(18,4)) AS DOUBLE) AS real_value, '0' AS status
        FROM amounts GROUP BY item_name, type_id""",
    "write_counts": f"""
        WITH cut AS (SELECT TIMESTAMP '{P.SPLIT}' AS split),
        early AS ({_emit(SEED_AMOUNTS)}),
        counts AS (
          SELECT 'hour' AS table_name, 0 AS batch, (SELECT count(*) FROM early) AS n_rows UNION ALL
          SELECT 'hour', 1, (SELECT count(*) FROM hourly) - (SELECT count(*) FROM early) UNION ALL
          SELECT 'state', 0, count(DISTINCT (item_name, type_id)) FROM clean, cut WHERE reading_ts < split UNION ALL
          SELECT 'state', 1, count(DISTINCT (item_name, type_id)) FROM clean, cut WHERE reading_ts >= split UNION ALL
          SELECT 'queue', 0, count(DISTINCT (building_id, gate_id, strftime(reading_ts, '%Y%m%d%H')))
          FROM typed, cut WHERE reading_ts < split UNION ALL
          SELECT 'queue', 1, count(DISTINCT (building_id, gate_id, strftime(reading_ts, '%Y%m%d%H')))
          FROM typed, cut WHERE reading_ts >= split AND reading_ts <= TIMESTAMP '{P.NOW}' + INTERVAL 1 HOUR)
        SELECT table_name, CAST(n_rows AS BIGINT) AS n_rows, CAST(batch AS BIGINT) AS batch FROM counts""",
    "stream_ids": f"""
        SELECT item_name, type_id, row_number() OVER (ORDER BY late, item_name, type_id) AS id
        FROM (SELECT item_name, type_id, min(reading_ts) >= TIMESTAMP '{P.SPLIT}' AS late
              FROM clean GROUP BY item_name, type_id)""",
    "backfill_resume": _pipeline("history", with_state=False),
    "pipeline_backfill": _pipeline("history"),
    "pipeline_backfill_overlap": _pipeline("history"),
}


_QUERIES["virtual_propagate"] = _QUERIES["virtual_nested"]


def _with_views(query: str) -> str:
    query = query.strip()
    if query.startswith("WITH RECURSIVE "):
        return PREFIX.replace("WITH ", "WITH RECURSIVE ", 1) + ", " + query[len("WITH RECURSIVE "):]
    if query.startswith("WITH "):
        return PREFIX + ", " + query[len("WITH "):]
    return PREFIX + query


def oracle_sql() -> dict[str, str]:
    return {name: _with_views(query) for name, query in _QUERIES.items()}
