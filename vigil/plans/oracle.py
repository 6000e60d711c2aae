"""Independent SQL for every catalog key (DuckDB dialect).

Each statement starts from the driver tables, binds them to the bank shape
with the same expressions as ``vigil.plans.bindings``, and states the
operator in plain SQL: joins, ``IN`` / ``NOT EXISTS`` subqueries, and for the
sequence rules row numbering plus self-joins to the previous rows (not window
``lag``), so the Spark DataFrame code is checked against a differently built
formulation. Column names equal the Spark outputs.
"""

from __future__ import annotations

OPEN_END = "TIMESTAMP '2999-12-31 23:59:59'"
AS_OF = "TIMESTAMP '2024-01-31 06:00:00'"
BATCH = "DATE '2024-01-31'"
HIST0_AT = "TIMESTAMP '2024-01-01 00:00:00'"
HIST1_AT = "TIMESTAMP '2024-01-16 00:00:00'"
HIST1_CLOSE = "TIMESTAMP '2024-01-15 23:59:59'"
ACCOUNT_DATE = "DATE '1996-03-01'"
PASSPORT_DATE = "DATE '1998-01-10'"

# name -> (dependencies, body)
_CTE: dict[str, tuple[tuple[str, ...], str]] = {
    "seed_clients": ((), """
        SELECT CAST(c_custkey AS VARCHAR) AS client_id, c_name AS last_name,
               CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE c_mktsegment END AS first_name,
               n_name AS patronymic,
               DATE '1950-01-01' + CAST(c_custkey % 15000 AS INTEGER) AS date_of_birth,
               'P' || CAST(c_custkey AS VARCHAR) AS passport_num,
               CASE WHEN c_custkey % 5 = 0 THEN NULL
                    ELSE DATE '1998-01-01' + CAST(c_custkey % 120 AS INTEGER) END AS passport_valid_to,
               '+7 ' || CAST(c_custkey AS VARCHAR) AS phone,
               DATE '1900-01-01' AS create_dt, CAST(NULL AS DATE) AS update_dt
        FROM customer JOIN nation ON c_nationkey = n_nationkey"""),
    "dim_clients": (("seed_clients",), "SELECT * FROM seed_clients"),
    "dim_accounts": ((), """
        SELECT CAST(o_orderkey AS VARCHAR) AS account_num, CAST(o_orderdate AS DATE) AS valid_to,
               CAST(o_custkey AS VARCHAR) AS client, DATE '1900-01-01' AS create_dt,
               CAST(NULL AS DATE) AS update_dt
        FROM orders WHERE o_orderkey % 2 = 0"""),
    "dim_cards": ((), """
        SELECT CAST(o_orderkey AS VARCHAR) AS card_num,
               CAST(o_orderkey - o_orderkey % 2 AS VARCHAR) AS account_num,
               DATE '1900-01-01' AS create_dt, CAST(NULL AS DATE) AS update_dt
        FROM orders"""),
    "stg_tx": ((), """
        SELECT CAST(event_id AS VARCHAR) AS trans_id, ts AS trans_date,
               replace(CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR), '.', ',') AS amt,
               CAST(user_id AS VARCHAR) AS card_num,
               CASE WHEN event_type = 'click' THEN 'WITHDRAW'
                    WHEN event_type IN ('purchase', 'view') THEN 'PAYMENT'
                    ELSE 'DEPOSIT' END AS oper_type,
               CASE WHEN event_id % 4 = 0 THEN 'SUCCESS' ELSE 'REJECT' END AS oper_result,
               CAST(event_id % 100 AS VARCHAR) AS terminal
        FROM events"""),
    "facts": (("stg_tx",), f"SELECT *, {BATCH} AS batch_date FROM stg_tx"),
    "facts_daily": (("stg_tx",), "SELECT *, CAST(trans_date AS DATE) AS batch_date FROM stg_tx"),
    "fact_blacklist": ((), f"""
        SELECT 'P' || CAST(c_custkey AS VARCHAR) AS passport_num,
               DATE '2023-12-01' + CAST(c_custkey % 30 AS INTEGER) AS entry_dt, {BATCH} AS batch_date
        FROM customer WHERE c_custkey % 50 = 0
        UNION ALL
        SELECT 'P' || CAST(c_custkey AS VARCHAR), DATE '2023-12-01' + CAST(c_custkey % 30 AS INTEGER),
               {BATCH}
        FROM customer WHERE c_custkey % 100 = 0"""),
    "blacklist_daily": (("fact_blacklist",), """
        SELECT passport_num, entry_dt, entry_dt + 31 AS batch_date FROM fact_blacklist"""),
    "days": (("facts_daily",), "SELECT DISTINCT batch_date FROM facts_daily"),
    "term1": ((), """
        SELECT CAST(s_suppkey AS VARCHAR) AS terminal_id,
               CASE WHEN s_suppkey % 2 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type,
               n_name AS terminal_city, s_name AS terminal_address
        FROM supplier JOIN nation ON s_nationkey = n_nationkey"""),
    "term2": ((), """
        SELECT CAST(s_suppkey AS VARCHAR) AS terminal_id,
               CASE WHEN s_suppkey % 2 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type,
               CASE WHEN s_suppkey % 10 = 5 THEN r_name ELSE n_name END AS terminal_city,
               s_name AS terminal_address
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey
        WHERE s_suppkey % 10 <> 3
        UNION ALL
        SELECT CAST(s_suppkey + 100000 AS VARCHAR), 'POS', 'NEWCITY', s_name
        FROM supplier WHERE s_suppkey % 10 = 7"""),
    "hist0": (("term1",), f"""
        SELECT terminal_id, terminal_type, terminal_city, terminal_address, 0 AS deleted_flg,
               {HIST0_AT} AS effective_from, {OPEN_END} AS effective_to
        FROM term1"""),
    "cur0": (("hist0",), f"""
        SELECT terminal_id, terminal_type, terminal_city, terminal_address FROM hist0
        WHERE deleted_flg = 0 AND {HIST1_AT} BETWEEN effective_from AND effective_to"""),
    "new_rows": (("term2", "cur0"), """
        SELECT * FROM term2 s
        WHERE NOT EXISTS (SELECT 1 FROM cur0 c WHERE c.terminal_id = s.terminal_id)"""),
    "deleted_rows": (("term2", "cur0"), """
        SELECT * FROM cur0 c
        WHERE NOT EXISTS (SELECT 1 FROM term2 s WHERE s.terminal_id = c.terminal_id)"""),
    "changed_rows": (("term2", "cur0"), """
        SELECT s.* FROM cur0 c JOIN term2 s USING (terminal_id)
        WHERE c.terminal_type <> s.terminal_type OR c.terminal_city <> s.terminal_city
           OR c.terminal_address <> s.terminal_address"""),
    "hist1": (("hist0", "new_rows", "deleted_rows", "changed_rows"), f"""
        SELECT terminal_id, terminal_type, terminal_city, terminal_address, deleted_flg,
               effective_from,
               CASE WHEN effective_to = {OPEN_END}
                     AND (terminal_id IN (SELECT terminal_id FROM changed_rows)
                          OR terminal_id IN (SELECT terminal_id FROM deleted_rows))
                    THEN {HIST1_CLOSE} ELSE effective_to END AS effective_to
        FROM hist0
        UNION ALL SELECT *, 0, {HIST1_AT}, {OPEN_END} FROM new_rows
        UNION ALL SELECT *, 0, {HIST1_AT}, {OPEN_END} FROM changed_rows
        UNION ALL SELECT *, 1, {HIST1_AT}, {OPEN_END} FROM deleted_rows"""),
    "holders": (("dim_cards", "dim_accounts", "dim_clients"), """
        SELECT k.card_num, a.account_num, a.client AS client_id,
               c.last_name || ' ' || c.first_name || ' ' || c.patronymic AS fio,
               c.passport_num, c.phone
        FROM dim_cards k LEFT JOIN dim_accounts a ON k.account_num = a.account_num
             LEFT JOIN dim_clients c ON a.client = c.client_id"""),
}


HIST2_AT = "TIMESTAMP '2024-02-01 00:00:00'"
HIST2_CLOSE = "TIMESTAMP '2024-01-31 23:59:59'"


def _merge_ctes(prev: str, snap: str, at: str, close: str, out: str) -> dict[str, tuple]:
    """CTEs folding snapshot ``snap`` into history ``prev`` at ``at`` (new name ``out``)."""
    cur, new, gone, changed = f"{out}_cur", f"{out}_new", f"{out}_deleted", f"{out}_changed"
    return {
        cur: ((prev,), f"""
            SELECT terminal_id, terminal_type, terminal_city, terminal_address FROM {prev}
            WHERE deleted_flg = 0 AND {at} BETWEEN effective_from AND effective_to"""),
        new: ((snap, cur), f"""
            SELECT * FROM {snap} s
            WHERE NOT EXISTS (SELECT 1 FROM {cur} c WHERE c.terminal_id = s.terminal_id)"""),
        gone: ((snap, cur), f"""
            SELECT * FROM {cur} c
            WHERE NOT EXISTS (SELECT 1 FROM {snap} s WHERE s.terminal_id = c.terminal_id)"""),
        changed: ((snap, cur), f"""
            SELECT s.* FROM {cur} c JOIN {snap} s USING (terminal_id)
            WHERE c.terminal_type <> s.terminal_type OR c.terminal_city <> s.terminal_city
               OR c.terminal_address <> s.terminal_address"""),
        out: ((prev, new, gone, changed), f"""
            SELECT terminal_id, terminal_type, terminal_city, terminal_address, deleted_flg,
                   effective_from,
                   CASE WHEN effective_to = {OPEN_END}
                         AND (terminal_id IN (SELECT terminal_id FROM {changed})
                              OR terminal_id IN (SELECT terminal_id FROM {gone}))
                        THEN {close} ELSE effective_to END AS effective_to
            FROM {prev}
            UNION ALL SELECT *, 0, {at}, {OPEN_END} FROM {new}
            UNION ALL SELECT *, 0, {at}, {OPEN_END} FROM {changed}
            UNION ALL SELECT *, 1, {at}, {OPEN_END} FROM {gone}"""),
    }


_CTE.update(_merge_ctes("hist1", "term1", HIST2_AT, HIST2_CLOSE, "hist2"))


_CTE["hist_w0"] = (("hist0",), "SELECT * FROM hist0 WHERE false")
_CTE["hist_b0"] = (("hist0",), "SELECT * FROM hist0")
for _i in range(1, 9):
    _day = f"2024-01-{1 + _i:02d}"
    _CTE[f"snap_b{_i}"] = ((), f"""
        SELECT CAST(s_suppkey AS VARCHAR) AS terminal_id,
               CASE WHEN s_suppkey % 2 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type,
               CASE WHEN copy = 1 THEN 'NEWCITY'
                    WHEN (s_suppkey + {_i}) % 5 < 2 THEN r_name ELSE n_name END AS terminal_city,
               CASE WHEN (s_suppkey + {_i}) % 13 = 0 THEN NULL ELSE s_name END AS terminal_address
        FROM supplier JOIN nation ON s_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey CROSS JOIN (VALUES (0), (1)) v(copy)
        WHERE (s_suppkey + 3 * {_i}) % 11 <> 0
          AND (copy = 0 OR (s_suppkey % 10 = 7 AND {(1 + _i) % 3} = 0))""")
    for _h in ("hist_b", "hist_w"):
        _CTE.update(_merge_ctes(f"{_h}{_i - 1}", f"snap_b{_i}", f"TIMESTAMP '{_day} 05:00:00'",
                                f"TIMESTAMP '{_day} 04:59:59'", f"{_h}{_i}"))


def _with(names: tuple[str, ...], body: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in _CTE[n][0]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({_CTE[n][1]})" for n in order)
    return f"WITH {ctes}\n{body}"


def _enrich(hits: str, event_col: str, event_type: str) -> str:
    """Card-holder enrichment of hits (card_num, batch_date, event) as report rows."""
    return f"""
        SELECT h.{event_col} AS event_dt, c.passport_num AS passport,
               c.last_name || ' ' || c.first_name || ' ' || c.patronymic AS fio, c.phone,
               '{event_type}' AS event_type, {AS_OF} AS report_dt, h.batch_date
        FROM {hits} h LEFT JOIN dim_cards k ON h.card_num = k.card_num
             LEFT JOIN dim_accounts a ON k.account_num = a.account_num
             LEFT JOIN dim_clients c ON a.client = c.client_id"""


_ACCOUNT_RULE = f"""
    SELECT t.trans_date AS event_dt, c.passport_num AS passport,
           c.last_name || ' ' || c.first_name || ' ' || c.patronymic AS fio, c.phone,
           'account cheat' AS event_type, {AS_OF} AS report_dt, {BATCH} AS batch_date
    FROM dim_accounts a LEFT JOIN dim_clients c ON a.client = c.client_id
         LEFT JOIN dim_cards k ON a.account_num = k.account_num
         LEFT JOIN facts t ON k.card_num = t.card_num
    WHERE a.valid_to < {ACCOUNT_DATE}"""

_FLAGGED = f"""
    SELECT client_id, last_name, first_name, patronymic, passport_num, phone
    FROM dim_clients
    WHERE COALESCE(passport_valid_to, DATE '2999-12-31') < {PASSPORT_DATE}
       OR passport_num IN (SELECT passport_num FROM fact_blacklist)"""

_PASSPORT_RULE = f"""
    SELECT t.trans_date AS event_dt, f.passport_num AS passport,
           f.last_name || ' ' || f.first_name || ' ' || f.patronymic AS fio, f.phone,
           'passport cheat' AS event_type, {AS_OF} AS report_dt, {BATCH} AS batch_date
    FROM ({_FLAGGED}) f
         LEFT JOIN dim_accounts a ON f.client_id = a.client
         LEFT JOIN dim_cards k ON a.account_num = k.account_num
         LEFT JOIN facts t ON k.card_num = t.card_num
         LEFT JOIN fact_blacklist b ON f.passport_num = b.passport_num"""

def _city_lag(facts: str, hist: str, as_of_match: bool = False) -> str:
    """Each transaction-version row with its predecessor on the card, found by
    numbering the rows and joining row n to row n - 1."""
    extra = (" AND h.deleted_flg = 0 AND t.trans_date BETWEEN h.effective_from AND h.effective_to"
             if as_of_match else "")
    return f"""
        WITH expanded AS (
            SELECT t.batch_date, t.card_num, t.trans_id, t.trans_date, t.oper_result,
                   h.terminal_city,
                   row_number() OVER (PARTITION BY t.batch_date, t.card_num
                       ORDER BY t.trans_date NULLS FIRST, t.trans_id NULLS FIRST,
                                t.terminal NULLS FIRST, t.oper_result NULLS FIRST,
                                h.effective_from NULLS FIRST, h.deleted_flg NULLS FIRST,
                                h.terminal_city NULLS FIRST) AS rn
            FROM {facts} t LEFT JOIN {hist} h ON t.terminal = h.terminal_id{extra}
            WHERE t.card_num IS NOT NULL)
        SELECT cur.batch_date, cur.card_num, cur.trans_id, cur.trans_date, cur.oper_result,
               cur.terminal_city, prev.terminal_city AS lag_city, prev.trans_date AS lag_time
        FROM expanded cur LEFT JOIN expanded prev
          ON prev.batch_date = cur.batch_date AND prev.card_num = cur.card_num
         AND prev.rn = cur.rn - 1"""


def _city_hits(lagged: str, minutes: int = 60) -> str:
    return f"""
        SELECT batch_date, card_num, min(trans_date) AS event_dt
        FROM ({lagged}) s
        WHERE trans_date < lag_time + INTERVAL {minutes} MINUTE
          AND terminal_city <> lag_city AND oper_result = 'SUCCESS'
        GROUP BY batch_date, card_num"""


def _amount_lag(facts: str = "facts") -> str:
    """Withdrawals and payments with the three rows before them on the card,
    found by numbering the rows and joining row n to rows n - 1, n - 2, n - 3
    (null-safe on the card: the unknown card is one sequence too)."""
    def prev(alias: str, back: int) -> str:
        return (f" LEFT JOIN numbered {alias} ON {alias}.batch_date = c.batch_date"
                f" AND {alias}.card_num IS NOT DISTINCT FROM c.card_num"
                f" AND {alias}.rn = c.rn - {back}")
    return f"""
    WITH numbered AS (
        SELECT *, TRY_CAST(replace(amt, ',', '.') AS DOUBLE) AS amt_value,
               row_number() OVER (PARTITION BY batch_date, card_num
                   ORDER BY trans_date NULLS FIRST, trans_id NULLS FIRST, amt NULLS FIRST,
                            oper_result NULLS FIRST, terminal NULLS FIRST) AS rn
        FROM {facts} WHERE oper_type IN ('WITHDRAW', 'PAYMENT'))
    SELECT c.batch_date, c.card_num, c.trans_id, c.trans_date, c.oper_result, c.amt_value,
           p3.trans_date AS lag_time,
           p1.oper_result AS lag_result_1, p2.oper_result AS lag_result_2,
           p3.oper_result AS lag_result_3,
           p1.amt_value AS lag_amt_1, p2.amt_value AS lag_amt_2, p3.amt_value AS lag_amt_3
    FROM numbered c{prev("p1", 1)}{prev("p2", 2)}{prev("p3", 3)}"""


def _amount_hits(facts: str = "facts") -> str:
    return f"""
    SELECT batch_date, card_num, trans_id, trans_date AS event_dt FROM ({_amount_lag(facts)}) s
    WHERE oper_result = 'SUCCESS' AND lag_result_1 = 'REJECT' AND lag_result_2 = 'REJECT'
      AND lag_result_3 = 'REJECT' AND lag_amt_3 > lag_amt_2 AND lag_amt_2 > lag_amt_1
      AND lag_amt_1 > amt_value AND trans_date < lag_time + INTERVAL 14400 MINUTE"""


_CITY_RULE = _enrich(f"({_city_hits(_city_lag('facts', 'hist1'))})", "event_dt", "city cheat")
_AMOUNT_RULE = _enrich(f"({_amount_hits()})", "event_dt", "selection of the amount")

_RULE_DEPS = ("dim_clients", "dim_accounts", "dim_cards", "facts", "fact_blacklist", "hist1")

_FEED_NAMES = """
    SELECT 'transactions_' || strftime(d, '%d%m%Y') || '.txt' AS file_name FROM days
    UNION ALL SELECT 'passport_blacklist_' || strftime(d, '%d%m%Y') || '.xlsx' FROM days
    UNION ALL SELECT 'terminals_' || strftime(d, '%d%m%Y') || '.xlsx' FROM days
              WHERE day(d) % 5 <> 0"""

_FEED_FILES = f"""
    WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events),
    names AS ({_FEED_NAMES})
    SELECT file_name,
           NULLIF(regexp_extract(file_name, '^(transactions|passport_blacklist|terminals)_\\d{{8}}', 1), '')
             AS feed,
           CAST(try_strptime(NULLIF(regexp_extract(file_name, '(\\d{{8}})', 1), ''), '%d%m%Y') AS DATE)
             AS batch_date
    FROM names"""

_COMPLETE = f"""
    SELECT batch_date, count(DISTINCT feed) AS n_feeds FROM ({_FEED_FILES}) f
    WHERE batch_date IS NOT NULL AND feed IS NOT NULL
    GROUP BY batch_date HAVING count(DISTINCT feed) = 3"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["dim_clients"] = _with(("dim_clients",), "SELECT * FROM dim_clients")
    q["dim_accounts"] = _with(("dim_accounts",), "SELECT * FROM dim_accounts")
    q["dim_cards"] = _with(("dim_cards",), "SELECT * FROM dim_cards")
    q["fact_transactions"] = _with(("facts",), "SELECT * FROM facts")
    q["fact_blacklist"] = _with(("fact_blacklist",), "SELECT * FROM fact_blacklist")
    q["card_holders"] = _with(("holders",), "SELECT * FROM holders")
    q["parse_amount"] = _with(("stg_tx",), """
        SELECT trans_id, amt, TRY_CAST(replace(amt, ',', '.') AS DOUBLE) AS amt_value
        FROM (SELECT trans_id, CASE WHEN CAST(trans_id AS BIGINT) % 10 = 0 THEN 'abc' ELSE amt END AS amt
              FROM stg_tx) s""")
    q["minutes_between"] = _with(("facts",), """
        SELECT batch_date, card_num, trans_id, trans_date, lag_time,
               CAST(date_diff('microsecond', lag_time, trans_date) AS DOUBLE)
                 / CAST(60000000 AS DOUBLE) AS gap_minutes
        FROM (SELECT *, lag(trans_date) OVER (PARTITION BY batch_date, card_num
                        ORDER BY trans_date NULLS FIRST, trans_id NULLS FIRST) AS lag_time
              FROM facts) s""")
    q["accounts_expired"] = _with(("dim_accounts", "dim_clients"), f"""
        SELECT {BATCH} AS batch_date, a.account_num, c.last_name, c.first_name, c.patronymic,
               c.passport_num, c.phone
        FROM dim_accounts a LEFT JOIN dim_clients c ON a.client = c.client_id
        WHERE a.valid_to < {ACCOUNT_DATE}""")
    q["clients_bad_passport"] = _with(("dim_clients", "fact_blacklist"), f"""
        SELECT {BATCH} AS batch_date, client_id, last_name, first_name, patronymic,
               passport_num, phone FROM ({_FLAGGED}) f""")
    q["rule_account"] = _with(_RULE_DEPS, _ACCOUNT_RULE)
    q["rule_passport"] = _with(_RULE_DEPS, _PASSPORT_RULE)
    q["report_daily"] = _with(_RULE_DEPS + ("facts_daily", "blacklist_daily", "days"), f"""
        SELECT t.trans_date AS event_dt, c.passport_num AS passport,
               c.last_name || ' ' || c.first_name || ' ' || c.patronymic AS fio, c.phone,
               'account cheat' AS event_type, {AS_OF} AS report_dt, d.batch_date
        FROM dim_accounts a JOIN days d ON a.valid_to < d.batch_date
             LEFT JOIN dim_clients c ON a.client = c.client_id
             JOIN dim_cards k ON a.account_num = k.account_num
             JOIN facts_daily t ON k.card_num = t.card_num AND t.batch_date = d.batch_date
        UNION ALL
        SELECT t.trans_date, f.passport_num, f.last_name || ' ' || f.first_name || ' ' || f.patronymic,
               f.phone, 'passport cheat', {AS_OF}, f.batch_date
        FROM (SELECT cl.*, d.batch_date FROM dim_clients cl JOIN days d
                ON COALESCE(cl.passport_valid_to, DATE '2999-12-31') < d.batch_date
                OR cl.passport_num IN (SELECT passport_num FROM blacklist_daily b
                                       WHERE b.batch_date = d.batch_date)) f
             JOIN dim_accounts a ON f.client_id = a.client
             JOIN dim_cards k ON a.account_num = k.account_num
             JOIN facts_daily t ON k.card_num = t.card_num AND t.batch_date = f.batch_date
             LEFT JOIN blacklist_daily b ON f.passport_num = b.passport_num
                                        AND b.batch_date = f.batch_date
        UNION ALL {_enrich(f"({_city_hits(_city_lag('facts_daily', 'hist1'))})", "event_dt",
                           "city cheat")}
        UNION ALL {_enrich(f"({_amount_hits('facts_daily')})", "event_dt",
                           "selection of the amount")}""")
    q["rule_account_daily"] = _with(_RULE_DEPS + ("facts_daily",), f"""
        SELECT t.trans_date AS event_dt, c.passport_num AS passport,
               c.last_name || ' ' || c.first_name || ' ' || c.patronymic AS fio, c.phone,
               'account cheat' AS event_type, {AS_OF} AS report_dt, d.batch_date
        FROM dim_accounts a
             JOIN (SELECT DISTINCT batch_date FROM facts_daily) d ON a.valid_to < d.batch_date
             LEFT JOIN dim_clients c ON a.client = c.client_id
             JOIN dim_cards k ON a.account_num = k.account_num
             JOIN facts_daily t ON k.card_num = t.card_num AND t.batch_date = d.batch_date""")
    q["rule_passport_daily"] = _with(_RULE_DEPS + ("facts_daily", "blacklist_daily", "days"), f"""
        SELECT t.trans_date AS event_dt, f.passport_num AS passport,
               f.last_name || ' ' || f.first_name || ' ' || f.patronymic AS fio, f.phone,
               'passport cheat' AS event_type, {AS_OF} AS report_dt, f.batch_date
        FROM (SELECT cl.*, d.batch_date FROM dim_clients cl JOIN days d
                ON COALESCE(cl.passport_valid_to, DATE '2999-12-31') < d.batch_date
                OR cl.passport_num IN (SELECT passport_num FROM blacklist_daily b
                                       WHERE b.batch_date = d.batch_date)) f
             LEFT JOIN dim_accounts a ON f.client_id = a.client
             LEFT JOIN dim_cards k ON a.account_num = k.account_num
             LEFT JOIN facts_daily t ON k.card_num = t.card_num AND t.batch_date = f.batch_date
             LEFT JOIN blacklist_daily b ON f.passport_num = b.passport_num
                                        AND b.batch_date = f.batch_date""")
    q["dq_duplicate_keys"] = _with(("dim_clients", "dim_accounts", "dim_cards", "fact_blacklist"), """
        SELECT 'dim_clients' AS relation, client_id AS key_value, count(*) AS n_rows
        FROM dim_clients WHERE client_id IS NOT NULL GROUP BY client_id HAVING count(*) > 1
        UNION ALL SELECT 'dim_accounts', account_num, count(*) FROM dim_accounts
        WHERE account_num IS NOT NULL GROUP BY account_num HAVING count(*) > 1
        UNION ALL SELECT 'dim_cards', card_num, count(*) FROM dim_cards
        WHERE card_num IS NOT NULL GROUP BY card_num HAVING count(*) > 1
        UNION ALL SELECT 'fact_blacklist', passport_num, count(*) FROM fact_blacklist
        WHERE passport_num IS NOT NULL GROUP BY passport_num HAVING count(*) > 1""")
    q["dq_orphans"] = _with(("dim_clients", "dim_accounts", "dim_cards", "facts", "hist1"), f"""
        SELECT 'cards.account_num' AS relation, account_num AS key_value, count(*) AS n_rows
        FROM dim_cards WHERE account_num IS NOT NULL
          AND account_num NOT IN (SELECT account_num FROM dim_accounts WHERE account_num IS NOT NULL)
        GROUP BY account_num
        UNION ALL SELECT 'accounts.client', client, count(*) FROM dim_accounts
        WHERE client IS NOT NULL
          AND client NOT IN (SELECT client_id FROM dim_clients WHERE client_id IS NOT NULL)
        GROUP BY client
        UNION ALL SELECT 'transactions.card_num', card_num, count(*) FROM facts
        WHERE card_num IS NOT NULL
          AND card_num NOT IN (SELECT card_num FROM dim_cards WHERE card_num IS NOT NULL)
        GROUP BY card_num
        UNION ALL SELECT 'transactions.terminal', terminal, count(*) FROM facts
        WHERE terminal IS NOT NULL AND terminal NOT IN (
            SELECT terminal_id FROM hist1 WHERE terminal_id IS NOT NULL AND deleted_flg = 0
               AND {HIST1_AT} BETWEEN effective_from AND effective_to)
        GROUP BY terminal""")
    q["cards_city_count"] = _with(("facts", "hist1"), """
        SELECT t.batch_date, t.card_num, count(DISTINCT h.terminal_city) AS cnt_city
        FROM facts t LEFT JOIN hist1 h ON t.terminal = h.terminal_id
        GROUP BY t.batch_date, t.card_num""")
    q["cards_multi_city"] = _with(("facts_daily", "hist0"), """
        SELECT t.batch_date, t.card_num, count(DISTINCT h.terminal_city) AS cnt_city
        FROM facts_daily t LEFT JOIN hist0 h ON t.terminal = h.terminal_id
        GROUP BY t.batch_date, t.card_num HAVING count(DISTINCT h.terminal_city) > 1""")
    q["cards_city_rolling"] = _with(("facts_daily", "hist1"), """
        SELECT a.batch_date, a.card_num, count(DISTINCT h.terminal_city) AS cnt_city
        FROM (SELECT DISTINCT batch_date, card_num FROM facts_daily) a
             JOIN facts_daily t ON t.card_num IS NOT DISTINCT FROM a.card_num
                               AND t.batch_date BETWEEN a.batch_date - 6 AND a.batch_date
             LEFT JOIN hist1 h ON t.terminal = h.terminal_id
        GROUP BY a.batch_date, a.card_num""")
    q["lag_city"] = _with(("facts", "hist0"), f"SELECT * FROM ({_city_lag('facts', 'hist0')}) s")
    q["lag_amount"] = _with(("facts",), f"SELECT * FROM ({_amount_lag()}) s")
    q["rule_city_hits"] = _with(("facts", "hist1"), _city_hits(_city_lag("facts", "hist1")))
    q["rule_city"] = _with(_RULE_DEPS, _CITY_RULE)
    q["rule_city_asof"] = _with(_RULE_DEPS, _enrich(
        f"({_city_hits(_city_lag('facts', 'hist1', as_of_match=True))})", "event_dt", "city cheat"))
    q["rule_city_daily"] = _with(_RULE_DEPS + ("facts_daily", "hist0"), _enrich(
        f"({_city_hits(_city_lag('facts_daily', 'hist0'))})", "event_dt", "city cheat"))
    q["rule_amount"] = _with(_RULE_DEPS, _AMOUNT_RULE)
    q["report_all"] = _with(_RULE_DEPS, f"""
        {_ACCOUNT_RULE}
        UNION ALL {_PASSPORT_RULE}
        UNION ALL {_CITY_RULE}
        UNION ALL {_AMOUNT_RULE}""")
    q["scd2_current"] = _with(("hist1",), f"""
        SELECT terminal_id, terminal_type, terminal_city, terminal_address FROM hist1
        WHERE deleted_flg = 0 AND {HIST1_AT} BETWEEN effective_from AND effective_to""")
    q["scd2_new"] = _with(("new_rows",), "SELECT * FROM new_rows")
    q["scd2_deleted"] = _with(("deleted_rows",), "SELECT * FROM deleted_rows")
    q["scd2_changed"] = _with(("changed_rows",), "SELECT * FROM changed_rows")
    q["scd2_apply"] = _with(("hist1",), "SELECT * FROM hist1")
    q["scd2_apply_twice"] = _with(("hist2",), "SELECT * FROM hist2")
    q["stream_rule_amount"] = _with(("facts_daily",), f"""
        SELECT batch_date, card_num, trans_id, event_dt FROM ({_amount_hits('facts_daily')}) h""")
    q["warehouse_holders"] = q["card_holders"]
    q["warehouse_facts"] = _with(("facts_daily",), "SELECT * FROM facts_daily")
    q["warehouse_report"] = q["report_daily"]
    # the first of the eight loads starts from nothing, the others go on from it
    q["warehouse_history"] = _with(("hist_w8",), "SELECT * FROM hist_w8").replace(
        " AS (", " AS MATERIALIZED (")
    q["scd2_backfill"] = _with(("hist_b8",), "SELECT * FROM hist_b8").replace(
        " AS (", " AS MATERIALIZED (")
    q["ingest_delimited"] = _with(("facts",), "SELECT * FROM facts")
    q["stream_ingest"] = _with(("facts",), "SELECT * FROM facts")
    q["batch_date"] = _FEED_FILES
    q["complete_batches"] = _COMPLETE
    q["next_batch"] = f"SELECT min(batch_date) AS batch_date FROM ({_COMPLETE}) c"
    return q
