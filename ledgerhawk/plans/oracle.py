"""Independent DuckDB SQL for every registered query (the correctness gate).

Written directly against the driver's tables (views ``events``,
``customer``, ``supplier``, ``nation``) in plain window/group-by SQL: SCD
state comes from the closed form, reports from whole-partition LAG windows,
so the Spark operators are checked against a different formulation.
"""

from __future__ import annotations

from datetime import date, timedelta
from types import SimpleNamespace

from ..config import (
    FRAUD_AMOUNT_PROBE,
    FRAUD_CITY_HOP,
    FRAUD_EXPIRED_ACCOUNT,
    FRAUD_EXPIRED_PASSPORT,
)

#: The mapping and the days, written out here: the code under test has its own.
REPORT_DAY, LAST_DAY, RUN_TS = date(2024, 1, 15), date(2024, 1, 30), "2024-01-16 00:00:00"


def _mapping(text: str) -> dict[str, str]:
    return dict(pair.split("=") for pair in text.split())


def _dim(text: str) -> SimpleNamespace:
    source = _mapping(text)
    key, *attrs = source
    return SimpleNamespace(key=key, attrs=attrs, columns=list(source), source=source)


DIMS = {
    "clients": _dim("client_id=client last_name=last_name first_name=first_name patronymic=patronymic "
                    "date_of_birth=date_of_birth passport_num=passport passport_valid_to=passport_valid_to phone=phone"),
    "accounts": _dim("account_num=account valid_to=account_valid_to client=client"),
    "cards": _dim("card_num=card account_num=account"),
    "terminals": _dim("terminal_id=terminal terminal_type=terminal_type terminal_city=city terminal_address=address"),
}
FACT_SOURCE = _mapping("trans_id=trans_id trans_date=date card_num=card oper_type=oper_type amt=amount "
                       "oper_result=oper_result terminal=terminal")
LANDING_COLS = ("trans_id date card account account_valid_to client last_name first_name patronymic date_of_birth "
                "passport passport_valid_to phone oper_type amount oper_result terminal terminal_type city "
                "address").split()
LANDING_WIDTHS = {c: 50 for c in LANDING_COLS
                  if c not in ("date", "account_valid_to", "date_of_birth", "passport_valid_to", "amount")}

DN = "date_diff('day', DATE '2024-01-01', CAST(e.ts AS DATE))"

LANDING_SQL = f"""
landing AS (
  SELECT CAST(e.event_id AS VARCHAR) AS trans_id,
         CAST(e.ts AS TIMESTAMP) AS date,
         'C' || e.user_id AS card,
         'A' || e.user_id || '-' || (({DN} + e.user_id % 20) // 20) AS account,
         CAST(DATE '2024-01-10' + CAST(e.user_id % 40 AS INTEGER) AS TIMESTAMP) AS account_valid_to,
         CAST(c.c_custkey AS VARCHAR) AS client,
         c.c_name AS last_name,
         c.c_mktsegment AS first_name,
         n1.n_name AS patronymic,
         CAST(DATE '1970-01-01' + CAST(c.c_custkey % 9000 AS INTEGER) AS TIMESTAMP) AS date_of_birth,
         'P' || c.c_custkey || '-' || (({DN} + c.c_custkey % 15) // 15) AS passport,
         CAST(DATE '2024-01-05' + CAST((c.c_custkey * 7) % 60 AS INTEGER) AS TIMESTAMP) AS passport_valid_to,
         '+7' || c.c_custkey AS phone,
         CASE WHEN e.event_type = 'purchase' THEN 'payment'
              WHEN e.event_type = 'signup' THEN 'refill' ELSE 'withdrawal' END AS oper_type,
         CAST(e.value AS DECIMAL(10,2)) AS amount,
         CASE WHEN e.event_type = 'purchase' THEN 'success' ELSE 'refused' END AS oper_result,
         'T' || s.s_suppkey AS terminal,
         CASE WHEN s.s_suppkey % 2 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type,
         n2.n_name AS city,
         'addr-' || s.s_suppkey || '-' || (({DN} + s.s_suppkey) // 10) AS address
  FROM events e
  JOIN customer c ON c.c_custkey = e.user_id
  JOIN nation n1 ON n1.n_nationkey = c.c_nationkey
  JOIN supplier s ON s.s_suppkey = e.event_id % (SELECT max(s_suppkey) + 1 FROM supplier)
  JOIN nation n2 ON n2.n_nationkey = s.s_nationkey
)"""

def _ts(d: date) -> str:
    return f"TIMESTAMP '{d.isoformat()} 00:00:00'"


def _next(d: date) -> date:
    return d + timedelta(days=1)


def _on_day(col: str, d: date) -> str:
    return f"({col} >= {_ts(d)} AND {col} < {_ts(_next(d))})"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def stg_sql(name: str, cte: str, where: str) -> str:
    """Staging CTE of a dimension (or the fact) from landing."""
    if name == "transactions":
        cols = ", ".join(f"{src} AS {dst}" for dst, src in FACT_SOURCE.items())
    else:
        cols = ", ".join(f"{src} AS {dst}" for dst, src in DIMS[name].source.items()) + ", date AS create_dt"
    return f"{cte} AS (SELECT {cols} FROM landing WHERE {where})"


def hist_sql(name: str, upto: date, p: str) -> list[str]:
    """Closed-form SCD2 history of a dimension through day ``upto``:
    CTEs ``{p}_stg``, ``{p}_var``, ``{p}_mk``, ``{p}_hist``."""
    spec = DIMS[name]
    cols = ", ".join(spec.columns)
    attrs = ", ".join(spec.attrs)
    lags = ", ".join(f"LAG({a}) OVER w AS p_{a}" for a in spec.attrs)
    diff = " OR ".join(f"p_{a} <> {a}" for a in spec.attrs)
    return [
        stg_sql(name, f"{p}_stg", f"date IS NOT NULL AND date < {_ts(_next(upto))}"),
        f"""{p}_var AS (SELECT {cols}, MIN(create_dt) AS start_dt FROM {p}_stg
             WHERE {spec.key} IS NOT NULL GROUP BY {cols}, CAST(create_dt AS DATE))""",
        f"""{p}_mk AS (SELECT *, ROW_NUMBER() OVER w AS rn, {lags} FROM {p}_var
             WINDOW w AS (PARTITION BY {spec.key} ORDER BY start_dt, {attrs}))""",
        f"""{p}_hist AS (SELECT {cols}, start_dt,
             LEAD(start_dt) OVER (PARTITION BY {spec.key} ORDER BY start_dt, {attrs}) AS end_dt
             FROM {p}_mk WHERE rn = 1 OR {diff})""",
    ]


def scd1_sql(name: str, p: str) -> str:
    """SCD1 table from ``{p}_hist`` as CTE ``{p}_scd1``."""
    spec = DIMS[name]
    cols = ", ".join(spec.columns)
    return f"""{p}_scd1 AS (SELECT {cols}, first_start AS create_dt,
         CASE WHEN n_versions > 1 THEN start_dt END AS update_dt
         FROM (SELECT *, MIN(start_dt) OVER (PARTITION BY {spec.key}) AS first_start,
                      COUNT(*) OVER (PARTITION BY {spec.key}) AS n_versions FROM {p}_hist)
         WHERE end_dt IS NULL)"""


def current_dims_sql(upto: date) -> list[str]:
    """``cur_<dim>``: dimension rows in force after day ``upto``."""
    ctes = []
    for n in DIMS:
        ctes += hist_sql(n, upto, n)
        ctes.append(f"cur_{n} AS (SELECT * FROM {n}_hist WHERE end_dt IS NULL)")
    return ctes


def dims_in_force_sql(day: date) -> list[str]:
    """``cur_<dim>`` from the whole history: the version in force at the end of ``day``."""
    ctes = []
    for n in DIMS:
        ctes += hist_sql(n, LAST_DAY, n)
        ctes.append(f"""cur_{n} AS (SELECT * FROM {n}_hist WHERE start_dt < {_ts(_next(day))}
             AND (end_dt IS NULL OR end_dt >= {_ts(_next(day))}))""")
    return ctes


PROFILE_SQL = """profile AS (
  SELECT cd.card_num, ac.valid_to AS account_valid_to, cl.passport_num, cl.passport_valid_to,
         cl.last_name || ' ' || cl.first_name || ' ' || cl.patronymic AS fio, cl.phone
  FROM cur_cards cd
  JOIN cur_accounts ac ON cd.account_num = ac.account_num
  JOIN cur_clients cl ON ac.client = cl.client_id)"""


def _with(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join([LANDING_SQL, *ctes]) + "\n" + body


#: The landing rows with the faults that the Spark queries inject, in SQL of its own.
_DIRTY_SQL = LANDING_SQL.replace("landing AS (", "clean AS (", 1) + """,
landing AS (SELECT * REPLACE (
    CASE WHEN CAST(trans_id AS BIGINT) % 7 <> 3 THEN passport END AS passport,
    CASE WHEN CAST(trans_id AS BIGINT) % 11 <> 5 THEN phone END AS phone,
    CASE WHEN CAST(trans_id AS BIGINT) % 83 <> 7 THEN client END AS client,
    CASE WHEN CAST(trans_id AS BIGINT) % 13 = 1 THEN 'gift' ELSE oper_type END AS oper_type,
    CASE WHEN CAST(trans_id AS BIGINT) % 17 <> 2 THEN oper_result END AS oper_result,
    CASE WHEN CAST(trans_id AS BIGINT) % 19 = 4 THEN repeat('x', 60) ELSE last_name END AS last_name)
  FROM clean)"""
#: Picks a third of the keys, alike in both engines.
_LAST = "ascii(right({c}, 1))"


def _dirty_with(ctes: list[str], body: str) -> str:
    return _with(ctes, body).replace(LANDING_SQL, _DIRTY_SQL)


def _report_select(src: str, fraud_dt: str, fraud_type: str, report_dt: str) -> str:
    return (f"SELECT {fraud_dt} AS fraud_dt, passport_num AS passport, fio, phone, "
            f"{fraud_type} AS fraud_type, {report_dt} AS report_dt FROM {src}")


D = REPORT_DAY
RUN = f"TIMESTAMP '{RUN_TS}'"


def _fact_day() -> str:
    return stg_sql("transactions", "fact", f"{_on_day('date', D)}")


def _rule12(cond: str, ftype: str) -> str:
    return _with(current_dims_sql(D) + [_fact_day(), PROFILE_SQL],
                 _report_select(f"fact JOIN profile USING (card_num) WHERE {cond}", "trans_date",
                                _q(ftype), RUN))


CITY_SEQ_CTES = [
    """cseq AS (
  SELECT f.card_num, f.trans_id, f.trans_date, t.terminal_city AS cur_city,
         LAG(f.trans_date) OVER w AS prev_trans_date, LAG(t.terminal_city) OVER w AS prev_city
  FROM fact f JOIN cur_terminals t ON f.terminal = t.terminal_id
  WHERE f.card_num IS NOT NULL
  WINDOW w AS (PARTITION BY f.card_num ORDER BY f.trans_date, f.trans_id))""",
]

CITY_HOPS_SQL = """hops AS (SELECT card_num, trans_date FROM cseq
  WHERE trans_date - prev_trans_date <= INTERVAL 1 HOUR AND prev_city <> cur_city)"""

AMOUNT_SEQ_SQL = """aseq AS (
  SELECT card_num, CAST(trans_date AS DATE) AS day, COUNT(*) AS n_trans,
         MAX(trans_date) AS last_trans_date,
         CAST(SUM(CASE WHEN oper_result = 'refused' THEN 0 WHEN oper_result = 'success' THEN 1 END) AS BIGINT)
           AS oper_result_total,
         CAST(SUM(CASE WHEN prev_amt IS NULL THEN 0 WHEN amt < prev_amt THEN 0 ELSE 1 END) AS BIGINT)
           AS prev_less_than_cur_total,
         arg_max(oper_result, {'d': trans_date, 'i': trans_id}) AS last_oper
  FROM (SELECT *, LAG(amt) OVER (PARTITION BY card_num ORDER BY trans_date, trans_id) AS prev_amt
        FROM fact WHERE card_num IS NOT NULL) q
  GROUP BY card_num, CAST(trans_date AS DATE)
  HAVING COUNT(*) > 3)"""

PROBES_SQL = """probes AS (SELECT card_num, last_trans_date AS trans_date FROM aseq
  WHERE oper_result_total = 1 AND last_oper = 'success' AND prev_less_than_cur_total = 0)"""


def _report_day_sql(dims) -> str:
    ctes = dims(D) + [_fact_day(), PROFILE_SQL, *CITY_SEQ_CTES, CITY_HOPS_SQL,
                                  AMOUNT_SEQ_SQL, PROBES_SQL]
    body = "\nUNION ALL\n".join([
        _report_select(
            "fact JOIN profile USING (card_num) WHERE passport_valid_to < trans_date",
            "trans_date", _q(FRAUD_EXPIRED_PASSPORT), RUN),
        _report_select(
            "fact JOIN profile USING (card_num) WHERE account_valid_to < trans_date",
            "trans_date", _q(FRAUD_EXPIRED_ACCOUNT), RUN),
        _report_select("hops JOIN profile USING (card_num)", "trans_date", _q(FRAUD_CITY_HOP), RUN),
        _report_select("probes JOIN profile USING (card_num)", "trans_date", _q(FRAUD_AMOUNT_PROBE), RUN),
    ])
    return _with(ctes, body)


def _report_all_days_sql() -> str:
    """Each day's report, dimensions taken as they stood after that day."""
    ctes = []
    for n in DIMS:
        ctes += hist_sql(n, LAST_DAY, n)
        ctes.append(f"""v_{n} AS (SELECT *, CAST(start_dt AS DATE) AS from_day,
                        CAST(end_dt AS DATE) AS to_day FROM {n}_hist)""")
    valid = "{a}.from_day <= f.day AND ({a}.to_day IS NULL OR {a}.to_day > f.day)"
    ctes += [
        stg_sql("transactions", "fact0", "date IS NOT NULL AND card IS NOT NULL"),
        "fact AS (SELECT *, CAST(trans_date AS DATE) AS day FROM fact0)",
        f"""profile AS (
  SELECT f.card_num, f.day, ac.valid_to AS account_valid_to, cl.passport_num, cl.passport_valid_to,
         cl.last_name || ' ' || cl.first_name || ' ' || cl.patronymic AS fio, cl.phone
  FROM (SELECT DISTINCT card_num, day FROM fact) f
  JOIN v_cards cd ON cd.card_num = f.card_num AND {valid.format(a='cd')}
  JOIN v_accounts ac ON ac.account_num = cd.account_num AND {valid.format(a='ac')}
  JOIN v_clients cl ON cl.client_id = ac.client AND {valid.format(a='cl')})""",
        f"""cseq AS (
  SELECT f.card_num, f.day, f.trans_id, f.trans_date, t.terminal_city AS cur_city,
         LAG(f.trans_date) OVER w AS prev_trans_date, LAG(t.terminal_city) OVER w AS prev_city
  FROM fact f JOIN v_terminals t ON f.terminal = t.terminal_id AND {valid.format(a='t')}
  WINDOW w AS (PARTITION BY f.card_num, f.day ORDER BY f.trans_date, f.trans_id))""",
        """hops AS (SELECT card_num, day, trans_date FROM cseq
  WHERE trans_date - prev_trans_date <= INTERVAL 1 HOUR AND prev_city <> cur_city)""",
        """aseq AS (
  SELECT card_num, day, COUNT(*) AS n_trans, MAX(trans_date) AS last_trans_date,
         SUM(CASE WHEN oper_result = 'refused' THEN 0 WHEN oper_result = 'success' THEN 1 END) AS ort,
         SUM(CASE WHEN prev_amt IS NULL THEN 0 WHEN amt < prev_amt THEN 0 ELSE 1 END) AS plt,
         arg_max(oper_result, {'d': trans_date, 'i': trans_id}) AS last_oper
  FROM (SELECT *, LAG(amt) OVER (PARTITION BY card_num, day ORDER BY trans_date, trans_id) AS prev_amt
        FROM fact) q
  GROUP BY card_num, day HAVING COUNT(*) > 3)""",
        """probes AS (SELECT card_num, day, last_trans_date AS trans_date FROM aseq
  WHERE ort = 1 AND last_oper = 'success' AND plt = 0)""",
    ]
    rdt = "CAST(day + 1 AS TIMESTAMP)"
    body = "\nUNION ALL\n".join([
        _report_select("fact JOIN profile USING (card_num, day) WHERE passport_valid_to < trans_date",
                       "trans_date", _q(FRAUD_EXPIRED_PASSPORT), rdt),
        _report_select("fact JOIN profile USING (card_num, day) WHERE account_valid_to < trans_date",
                       "trans_date", _q(FRAUD_EXPIRED_ACCOUNT), rdt),
        _report_select("hops JOIN profile USING (card_num, day)", "trans_date", _q(FRAUD_CITY_HOP), rdt),
        _report_select("probes JOIN profile USING (card_num, day)", "trans_date", _q(FRAUD_AMOUNT_PROBE), rdt),
    ])
    return _with(ctes, body)


def _scd_state_sql(name: str, kind: str) -> str:
    ctes = hist_sql(name, LAST_DAY, name)
    if kind == "scd2":
        return _with(ctes, f"SELECT * FROM {name}_hist")
    ctes.append(scd1_sql(name, name))
    return _with(ctes, f"SELECT * FROM {name}_scd1")


def _audit_sql(kind: str) -> str:
    ctes, parts = [], []
    for n in DIMS:
        ctes += hist_sql(n, D, n)
        if kind == "scd1":
            ctes.append(scd1_sql(n, n))
            src, ins, upd = f"{n}_scd1", "create_dt", "update_dt"
        else:
            src, ins, upd = f"{n}_hist", "start_dt", "end_dt"
        for action, col in (("INSERTED", ins), ("UPDATED", upd)):
            parts.append(f"SELECT '{n}' AS table_name, '{action}' AS action, "
                         f"CAST(COUNT(*) AS INTEGER) AS amount, {RUN} AS action_date "
                         f"FROM {src} WHERE {_on_day(col, D)}")
    return _with(ctes, "\nUNION ALL\n".join(parts))


def _variants_sql(name: str) -> str:
    spec = DIMS[name]
    cols = ", ".join(spec.columns)
    return _with([stg_sql(name, "stg", _on_day("date", D))],
                 f"SELECT {cols}, MIN(create_dt) AS create_dt FROM stg "
                 f"WHERE {spec.key} IS NOT NULL GROUP BY {cols}")


def _dq_history_sql() -> str:
    ctes, parts = [], []
    for n, spec in DIMS.items():
        ctes += hist_sql(n, LAST_DAY, n)
        parts.append(f"""SELECT '{n}' AS table_name, COUNT(*) AS n_versions,
  COUNT(*) FILTER (WHERE end_dt IS NULL) AS n_open,
  COUNT(*) FILTER (WHERE n_open_k > 1 OR (end_dt IS NULL AND nxt IS NOT NULL)
                     OR (end_dt IS NOT NULL AND nxt IS NULL) OR end_dt <> nxt) AS n_violations
FROM (SELECT *, LEAD(start_dt) OVER (PARTITION BY {spec.key} ORDER BY start_dt) AS nxt,
             COUNT(*) FILTER (WHERE end_dt IS NULL) OVER (PARTITION BY {spec.key}) AS n_open_k
      FROM (SELECT * REPLACE (CASE WHEN {_LAST.format(c=spec.key)} % 3 = 0 THEN end_dt + INTERVAL 1 DAY ELSE end_dt END
                              AS end_dt) FROM {n}_hist)) h""")
    return _with(ctes, "\nUNION ALL\n".join(parts))


#: Fixed values, written out here as in :data:`DIMS`: text columns wider than 50 and the columns that are no text.
_WIDE = {"terminal_address": 100, "account_num": 100, "fio": 150, "fraud_type": 100}
_NO_TEXT = ("date_of_birth", "passport_valid_to", "valid_to", "trans_date", "amt", "fraud_dt", "report_dt")


def _dq_by_day_sql() -> str:
    """Every day's counts on the versions in force on that day, each by a subquery of its own."""
    ctes = ["""days AS (SELECT CAST(x AS DATE) AS day
        FROM range(TIMESTAMP '2024-01-05 00:00:00', TIMESTAMP '2024-01-31 00:00:00', INTERVAL 1 DAY) r(x))"""]
    parts = []

    def count(check: str, table: str, column: str, rows: str) -> None:
        parts.append(f"""SELECT '{check}' AS check_name, '{table}' AS table_name, '{column}' AS column_name,
            (SELECT COUNT(*) FROM {rows}) AS n_rows, d.day AS load_dt FROM days d""")

    def columns(table: str, names: list[str], src: str) -> None:
        for c in names:
            count("null", table, c, f"{src} AND v.{c} IS NULL")
            if c not in _NO_TEXT:
                count("width", table, c, f"{src} AND length(v.{c}) > {_WIDE.get(c, 50)}")

    for n, spec in DIMS.items():
        whole = " AND ".join(f"{c} IS NOT NULL" for c in spec.columns)
        ctes += [c.replace(f"WHERE {spec.key} IS NOT NULL GROUP BY", f"WHERE {whole} GROUP BY") for c in hist_sql(n, LAST_DAY, n)]
        ctes.append(f"""in_{n} AS (SELECT d.day, h.* FROM days d JOIN (SELECT * REPLACE (
            CASE WHEN {_LAST.format(c=spec.key)} % 3 = 0 THEN end_dt + INTERVAL 1 DAY ELSE end_dt END AS end_dt) FROM {n}_hist) h
            ON CAST(h.start_dt AS DATE) <= d.day AND (h.end_dt IS NULL OR CAST(h.end_dt AS DATE) > d.day))""")
        ctes.append(f"twice_{n} AS (SELECT day, {spec.key} FROM in_{n} GROUP BY day, {spec.key} HAVING COUNT(*) > 1)")
        count("duplicate_keys", n, spec.key, f"twice_{n} v WHERE v.day = d.day")
        columns(n, spec.columns, f"in_{n} v WHERE v.day = d.day")
    cols = ", ".join(f"{src} AS {dst}" for dst, src in FACT_SOURCE.items())
    ctes.append(f"facts AS (SELECT {cols}, CAST(date AS DATE) AS day FROM landing WHERE date < {_ts(_next(LAST_DAY))})")
    ctes.append("""twice_facts AS (SELECT day FROM facts WHERE trans_id IS NOT NULL AND oper_type IS NOT NULL
        AND oper_result IS NOT NULL GROUP BY day, trans_id, oper_type, oper_result HAVING COUNT(*) > 1)""")
    count("duplicate_keys", "transactions", "trans_id,oper_type,oper_result", "twice_facts v WHERE v.day = d.day")
    columns("transactions", list(FACT_SOURCE), "facts v WHERE v.day = d.day")
    for c, allowed in (("oper_type", "'withdrawal', 'refill', 'payment'"), ("oper_result", "'success', 'refused'")):
        count("domain", "transactions", c, f"facts v WHERE v.day = d.day AND (v.{c} IS NULL OR v.{c} NOT IN ({allowed}))")
    for table, src, fk, parent in (("accounts", "in_accounts", "client", "clients"), ("cards", "in_cards", "account_num", "accounts"),
                                   ("transactions", "facts", "card_num", "cards"), ("transactions", "facts", "terminal", "terminals")):
        key = DIMS[parent].key
        ctes.append(f"""alone_{table}_{fk} AS (SELECT v.day FROM {src} v LEFT JOIN (SELECT DISTINCT day, {key} AS k FROM in_{parent}) p
            ON p.day = v.day AND p.k = v.{fk} WHERE v.{fk} IS NOT NULL AND p.k IS NULL)""")
        count("orphans", table, fk, f"alone_{table}_{fk} v WHERE v.day = d.day")
    for c in ("fraud_dt", "passport", "fio", "phone", "fraud_type", "report_dt"):
        for check in ("null",) if c in _NO_TEXT else ("null", "width"):
            count(check, "report", c, "days v WHERE v.day < d.day AND v.day > d.day")
    return _dirty_with(ctes, "\nUNION ALL\n".join(parts))


def build() -> dict[str, str]:
    o: dict[str, str] = {}
    all_cols = ", ".join(LANDING_COLS)
    o["landing_conform"] = _with([], "SELECT " + ", ".join(
        "CAST(NULL AS VARCHAR) AS address" if c == "address" else c for c in LANDING_COLS) + " FROM landing")
    o["landing_drop_blank"] = _with([], f"SELECT {all_cols} FROM landing")
    o["late_split"] = _with([], f"""SELECT trans_id, date,
        CASE WHEN date IS NULL THEN 'no_date' WHEN date < {_ts(D)} THEN 'late' ELSE 'early' END AS reason
        FROM landing WHERE NOT {_on_day('date', D)} OR date IS NULL""")
    for n in ("clients", "accounts", "cards", "terminals", "transactions"):
        o[f"stage_{n}"] = _with([stg_sql(n, "stg", _on_day("date", D))], "SELECT * FROM stg")
    for n in DIMS:
        o[f"variants_{n}"] = _variants_sql(n)
    for n in DIMS:
        o[f"scd1_{n}"] = _scd_state_sql(n, "scd1")
    prev = D - timedelta(days=1)
    acc = DIMS["accounts"]
    acc_cols = ", ".join(acc.columns)
    o["scd1_insert_gate"] = _with(
        hist_sql("accounts", prev, "a") + [scd1_sql("accounts", "a"), stg_sql("accounts", "stg", _on_day("date", D)),
                                           f"""v AS (SELECT {acc_cols}, MIN(create_dt) AS create_dt FROM stg
                                               WHERE account_num IS NOT NULL GROUP BY {acc_cols})"""],
        f"""SELECT v.*, 'per_key' AS gate FROM v WHERE account_num NOT IN (SELECT account_num FROM a_scd1)
            UNION ALL
            SELECT v.*, 'all_or_nothing' AS gate FROM v
            WHERE NOT EXISTS (SELECT 1 FROM a_scd1 WHERE account_num IN (SELECT account_num FROM v))""")
    for n in DIMS:
        o[f"scd2_{n}"] = _scd_state_sql(n, "scd2")
    o["scd2_insert_not_in"] = _with(
        hist_sql("accounts", prev, "h") + [stg_sql("accounts", "stg", _on_day("date", D))],
        f"""SELECT {acc_cols}, MIN(create_dt) AS create_dt FROM stg
            WHERE account_num NOT IN (SELECT account_num FROM h_hist WHERE account_num IS NOT NULL)
            GROUP BY {acc_cols}""")
    o["scd1_literal_accounts"] = _with(
        hist_sql("accounts", prev, "a") + [scd1_sql("accounts", "a"), stg_sql("accounts", "stg", _on_day("date", D)),
                                           f"""v AS (SELECT {acc_cols}, MIN(create_dt) AS create_dt FROM stg
                                               WHERE account_num IS NOT NULL GROUP BY {acc_cols})""",
                                           """u AS (SELECT v.* FROM v JOIN a_scd1 p USING (account_num)
                                               WHERE v.valid_to <> p.valid_to OR v.client <> p.client)"""],
        """SELECT p.account_num, COALESCE(u.valid_to, p.valid_to) AS valid_to, COALESCE(u.client, p.client) AS client,
                  p.create_dt, COALESCE(u.create_dt, p.update_dt) AS update_dt
           FROM a_scd1 p LEFT JOIN u USING (account_num)
           UNION ALL
           SELECT account_num, valid_to, client, create_dt, NULL AS update_dt FROM v
           WHERE NOT EXISTS (SELECT 1 FROM a_scd1 WHERE account_num IN (SELECT account_num FROM v))""")
    o["scd2_cards_literal"] = _with(
        hist_sql("cards", prev, "h") + [
            stg_sql("cards", "stg", _on_day("date", D)),
            """v AS (SELECT card_num, account_num, MIN(create_dt) AS create_dt FROM stg
                     WHERE card_num IS NOT NULL GROUP BY card_num, account_num)""",
            """a AS (SELECT h.card_num, h.account_num, h.start_dt,
                       COALESCE(h.end_dt, (SELECT MIN(v.create_dt) FROM v WHERE v.card_num = h.card_num
                                          AND v.account_num <> h.account_num AND h.end_dt IS NULL)) AS end_dt
                     FROM h_hist h)""",
            """b AS (SELECT v.card_num, v.account_num, v.create_dt AS start_dt, CAST(NULL AS TIMESTAMP) AS end_dt
                     FROM v, a WHERE a.card_num = v.card_num AND a.end_dt = v.create_dt
                     AND a.account_num <> v.account_num)""",
            "ab AS (SELECT * FROM a UNION ALL SELECT * FROM b)"],
        """SELECT * FROM ab
           UNION ALL
           SELECT card_num, account_num, create_dt AS start_dt, CAST(NULL AS TIMESTAMP) AS end_dt FROM v
           WHERE account_num NOT IN (SELECT card_num FROM ab WHERE card_num IS NOT NULL)""")
    o["audit_scd1"] = _audit_sql("scd1")
    o["audit_scd2"] = _audit_sql("scd2")
    o["audit_fact"] = _with([], f"""SELECT 'transactions' AS table_name, 'INSERTED' AS action,
        CAST(COUNT(*) AS INTEGER) AS amount, {RUN} AS action_date FROM landing WHERE {_on_day('date', D)}""")
    o["fact_load"] = _with([_fact_day()], "SELECT *, CAST(trans_date AS DATE) AS trans_dt FROM fact")
    o["fact_by_partition"] = _with([], """SELECT CAST(date AS DATE) AS trans_dt, oper_type, oper_result,
        COUNT(*) AS n_rows FROM landing WHERE date IS NOT NULL GROUP BY ALL""")
    o["busy_cards"] = _with([_fact_day()], """SELECT card_num, CAST(trans_date AS DATE) AS day,
        COUNT(*) AS n_trans FROM fact WHERE card_num IS NOT NULL GROUP BY ALL HAVING COUNT(*) > 1""")
    enriched = ("SELECT trans_id, trans_date, card_num, passport_num, fio, phone, passport_valid_to, "
                "account_valid_to FROM fact JOIN profile USING (card_num)")
    o["tx_enriched"] = _with(current_dims_sql(D) + [_fact_day(), PROFILE_SQL], enriched)
    o["tx_enriched_current"] = _with(dims_in_force_sql(D) + [_fact_day(), PROFILE_SQL], enriched)
    o["city_sequence"] = _with(current_dims_sql(D) + [_fact_day(), *CITY_SEQ_CTES], "SELECT * FROM cseq")
    o["amount_sequence"] = _with([_fact_day(), AMOUNT_SEQ_SQL], "SELECT * FROM aseq")
    o["rule_expired_passport"] = _rule12("passport_valid_to < trans_date", FRAUD_EXPIRED_PASSPORT)
    o["rule_expired_account"] = _rule12("account_valid_to < trans_date", FRAUD_EXPIRED_ACCOUNT)
    o["rule_city_hop"] = _with(current_dims_sql(D) + [_fact_day(), PROFILE_SQL, *CITY_SEQ_CTES, CITY_HOPS_SQL],
                               _report_select("hops JOIN profile USING (card_num)", "trans_date",
                                              _q(FRAUD_CITY_HOP), RUN))
    o["rule_amount_probe"] = _with(current_dims_sql(D) + [_fact_day(), PROFILE_SQL, AMOUNT_SEQ_SQL, PROBES_SQL],
                                   _report_select("probes JOIN profile USING (card_num)", "trans_date",
                                                  _q(FRAUD_AMOUNT_PROBE), RUN))
    o["report_day_scd1"] = _report_day_sql(current_dims_sql)
    o["report_day_scd2"] = _report_day_sql(dims_in_force_sql)
    o["report_all_days"] = _report_all_days_sql()
    states = [x for n in DIMS for x in [*hist_sql(n, LAST_DAY, n), scd1_sql(n, n)]]
    o["dq_duplicate_keys"] = _with(states, "\nUNION ALL\n".join(
        f"""SELECT '{table}' AS table_name, COUNT(*) AS n_keys, CAST(2 * COUNT(*) AS BIGINT) AS n_rows FROM {src}
            WHERE {_LAST.format(c=spec.key)} % 3 = 0"""
        for n, spec in DIMS.items() for table, src in ((f"dim_{n}", f"{n}_scd1"), (f"dim_{n}_hist", f"{n}_hist"))))
    old = [x for n in DIMS for x in hist_sql(n, prev, f"old_{n}")]
    now = [x for n in DIMS for x in hist_sql(n, date(9999, 1, 1), n)]
    o["dq_orphans"] = _with(old + now, "\nUNION ALL\n".join(
        f"""SELECT '{child}' AS child, '{parent}' AS parent, COUNT(*) AS n_rows FROM {src}
            WHERE {fk} IS NOT NULL AND {fk} NOT IN (SELECT {key} FROM old_{parent}_hist)"""
        for child, src, fk, parent, key in (
            ("accounts", "(SELECT * FROM accounts_hist WHERE end_dt IS NULL)", "client", "clients", "client_id"),
            ("cards", "(SELECT * FROM cards_hist WHERE end_dt IS NULL)", "account_num", "accounts", "account_num"),
            ("fact", "(SELECT card FROM landing WHERE date IS NOT NULL)", "card", "cards", "card_num"),
            ("fact", "(SELECT terminal FROM landing WHERE date IS NOT NULL)", "terminal", "terminals", "terminal_id"))))
    refused = {"clients": "client last_name first_name patronymic date_of_birth passport passport_valid_to phone",
               "accounts": "account account_valid_to client", "cards": "card account",
               "terminals": "terminal terminal_type city address",
               "transactions": "trans_id date card oper_type amount oper_result terminal"}
    named = {("clients", "client"): "client_id", ("clients", "passport"): "passport_num",
             ("accounts", "account"): "account_num", ("accounts", "account_valid_to"): "valid_to",
             ("cards", "card"): "card_num", ("cards", "account"): "account_num", ("terminals", "terminal"): "terminal_id",
             ("terminals", "city"): "terminal_city", ("terminals", "address"): "terminal_address",
             ("transactions", "date"): "trans_date", ("transactions", "card"): "card_num",
             ("transactions", "amount"): "amt"}
    o["dq_nulls"] = _dirty_with([], "\nUNION ALL\n".join(
        f"""SELECT '{named.get((t, c), c)}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS n_null,
            '{t}' AS table_name FROM landing WHERE date IS NOT NULL""" for t, cols in refused.items() for c in cols.split()))
    o["dq_domain"] = _dirty_with([], """
        SELECT 'oper_type' AS column_name, oper_type AS value, COUNT(*) AS n_rows FROM landing
        WHERE date IS NOT NULL AND (oper_type IS NULL OR oper_type NOT IN ('withdrawal', 'refill', 'payment')) GROUP BY 2
        UNION ALL
        SELECT 'oper_result', oper_result, COUNT(*) FROM landing
        WHERE date IS NOT NULL AND (oper_result IS NULL OR oper_result NOT IN ('success', 'refused')) GROUP BY 2""")
    o["dq_width"] = _dirty_with([], "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE length({c}) > {w}) AS n_too_long FROM landing"
        for c, w in LANDING_WIDTHS.items()))
    o["dq_numeric"] = _with([], """SELECT trans_id FROM landing
        WHERE CAST(trans_id AS BIGINT) % 23 = 6 AND abs(amount) * 1000000000 >= 100000000""")
    o["landing_rejects"] = _with(["""bad AS (SELECT trans_id, CAST(trans_id AS BIGINT) % 97 = 3 AS d,
        CAST(trans_id AS BIGINT) % 89 = 5 AS a, CAST(trans_id AS BIGINT) % 83 = 7 AS c FROM landing)"""],
        """SELECT trans_id, 'bad_cell' AS reason FROM bad WHERE d OR a
           UNION ALL SELECT trans_id, 'null_column:transactions' FROM bad WHERE d OR a
           UNION ALL SELECT trans_id, 'null_key:clients' FROM bad WHERE c
           UNION ALL SELECT trans_id, 'null_attribute:accounts' FROM bad WHERE c""")
    for mode in ("scd1", "scd2"):
        o[f"{mode}_clients_nulls"] = o[f"{mode}_clients"].replace(LANDING_SQL, _DIRTY_SQL).replace(
            "WHERE client_id IS NOT NULL GROUP BY",
            "WHERE client_id IS NOT NULL AND passport_num IS NOT NULL AND phone IS NOT NULL GROUP BY")
    o["rule_amount_probe_ref"] = o["rule_amount_probe"]
    o["dq_history"] = _dq_history_sql()
    o["dq_by_day"] = _dq_by_day_sql()
    again = """again AS (
        SELECT trans_id, oper_type, oper_result, date, 0 AS copy FROM landing
        UNION ALL SELECT trans_id, oper_type, oper_result, date + INTERVAL 1 HOUR, 1 FROM landing WHERE CAST(trans_id AS BIGINT) % 5 = 0
        UNION ALL SELECT trans_id, oper_type, oper_result, date + INTERVAL 24 HOUR, 2 FROM landing WHERE CAST(trans_id AS BIGINT) % 7 = 3),
      placed AS (SELECT *, row_number() OVER (PARTITION BY trans_id, oper_type, oper_result ORDER BY date, copy) AS n FROM again)"""
    o["fact_duplicates"] = _with([again], f"""SELECT trans_id, oper_type, oper_result, date, copy FROM placed
        WHERE n > 1 AND {_on_day('date', REPORT_DAY)}""")
    o["fact_unique"] = _with([again], f"""SELECT CAST(date AS DATE) AS trans_dt, COUNT(*) AS n_rows,
        COUNT(*) FILTER (WHERE copy > 0) AS n_late FROM placed WHERE n = 1 AND date < {_ts(_next(LAST_DAY))} GROUP BY 1""")
    o["landing_written"] = _with(["""written AS (SELECT CAST(date AS DATE) AS batch_dt, CAST(trans_id AS BIGINT) AS i FROM landing)"""],
        """SELECT batch_dt, COUNT(*) AS n_rows, CAST(SUM(i) AS BIGINT) AS ids, CAST(0 AS BIGINT) AS n_bad FROM written
           WHERE i % 4 = 1 OR day(batch_dt) % 3 <> 0 OR i % 8 <> 2 GROUP BY batch_dt""")
    return o
