"""Table schemas and the fixed values shared by every operator."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the source system's values for equal results.
#   open end of a history row:        2999-12-31 23:59:59
#   end date of a passport without one: 2999-12-31
#   closing a version: one second before the load time
#   report event types, in the order the rules run:
#     'account cheat', 'passport cheat', 'city cheat', 'selection of the amount'
#   operation results: 'SUCCESS', 'REJECT'
#   operation types the amount rule reads: 'WITHDRAW', 'PAYMENT'
#   city rule: 60 minutes; amount rule: 20 minutes
#   file names: transactions_DDMMYYYY.txt, passport_blacklist_DDMMYYYY.xlsx,
#               terminals_DDMMYYYY.xlsx; the date is the first run of 8 digits
# ---------------------------------------------------------------------------
OPEN_END = dt.datetime(2999, 12, 31, 23, 59, 59)
NO_EXPIRY = dt.date(2999, 12, 31)
CLOSE_OFFSET_SECONDS = 1

EVENT_ACCOUNT = "account cheat"
EVENT_PASSPORT = "passport cheat"
EVENT_CITY = "city cheat"
EVENT_AMOUNT = "selection of the amount"
EVENT_TYPES = (EVENT_ACCOUNT, EVENT_PASSPORT, EVENT_CITY, EVENT_AMOUNT)

RESULT_SUCCESS = "SUCCESS"
RESULT_REJECT = "REJECT"
AMOUNT_OPER_TYPES = ("WITHDRAW", "PAYMENT")
CITY_MAX_MINUTES = 60
AMOUNT_MAX_MINUTES = 20

FEED_TRANSACTIONS = "transactions"
FEED_BLACKLIST = "passport_blacklist"
FEED_TERMINALS = "terminals"
FEEDS = (FEED_TRANSACTIONS, FEED_BLACKLIST, FEED_TERMINALS)
FEED_EXTENSIONS = {FEED_TRANSACTIONS: "txt", FEED_BLACKLIST: "xlsx", FEED_TERMINALS: "xlsx"}
#: other formats that a workbook feed may come in
TABLE_EXTENSIONS = {FEED_BLACKLIST: ("csv", "parquet"), FEED_TERMINALS: ("csv", "parquet")}
FILE_DATE_PATTERN = r"(\d{8})"
FILE_DATE_FORMAT = "ddMMyyyy"


def _s(name: str, dtype: T.DataType = T.StringType(), nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable)


# --- seed dimension sources ------------------------------------------------
SEED_CARDS = T.StructType([_s("card_num"), _s("account"), _s("create_dt", T.DateType()),
                           _s("update_dt", T.DateType())])
SEED_ACCOUNTS = T.StructType([_s("account"), _s("valid_to", T.DateType()), _s("client"),
                              _s("create_dt", T.DateType()), _s("update_dt", T.DateType())])
SEED_CLIENTS = T.StructType([
    _s("client_id"), _s("last_name"), _s("first_name"), _s("patronymic"),
    _s("date_of_birth", T.DateType()), _s("passport_num"), _s("passport_valid_to", T.DateType()),
    _s("phone"), _s("create_dt", T.DateType()), _s("update_dt", T.DateType()),
])

# --- daily feeds (as read: every field text, typed afterwards) -------------
TRANSACTIONS_FILE_COLUMNS = ("transaction_id", "transaction_date", "amount", "card_num",
                             "oper_type", "oper_result", "terminal")
TRANSACTIONS_FILE = T.StructType([_s(c) for c in TRANSACTIONS_FILE_COLUMNS])
BLACKLIST_FILE_COLUMNS = ("passport", "date")
TERMINALS_FILE_COLUMNS = ("terminal_id", "terminal_type", "terminal_city", "terminal_address")
TERMINAL_ATTRS = TERMINALS_FILE_COLUMNS

# --- warehouse tables ------------------------------------------------------
DIM_CLIENTS = SEED_CLIENTS
DIM_ACCOUNTS = T.StructType([_s("account_num"), _s("valid_to", T.DateType()), _s("client"),
                             _s("create_dt", T.DateType()), _s("update_dt", T.DateType())])
DIM_CARDS = T.StructType([_s("card_num"), _s("account_num"), _s("create_dt", T.DateType()),
                          _s("update_dt", T.DateType())])
FACT_TRANSACTIONS = T.StructType([
    _s("trans_id"), _s("trans_date", T.TimestampNTZType()), _s("amt"), _s("card_num"),
    _s("oper_type"), _s("oper_result"), _s("terminal"), _s("batch_date", T.DateType()),
])
FACT_BLACKLIST = T.StructType([_s("passport_num"), _s("entry_dt", T.DateType()),
                               _s("batch_date", T.DateType())])
TERMINALS_SNAPSHOT = T.StructType([_s(c) for c in TERMINALS_FILE_COLUMNS])
TERMINALS_HIST = T.StructType([
    _s("id", T.LongType()), _s("terminal_id"), _s("terminal_type"), _s("terminal_city"),
    _s("terminal_address"), _s("deleted_flg", T.IntegerType()),
    _s("effective_from", T.TimestampNTZType()), _s("effective_to", T.TimestampNTZType()),
])
REPORT = T.StructType([
    _s("event_dt", T.TimestampNTZType()), _s("passport"), _s("fio"), _s("phone"),
    _s("event_type"), _s("report_dt", T.TimestampNTZType()), _s("batch_date", T.DateType()),
])
#: key violations and unparsable values of a run
DQ_VIOLATIONS = ("relation string, key_value string, n_rows long, checked_at timestamp_ntz, "
                 "run string")
REPORT_COLUMNS = tuple(f.name for f in REPORT.fields)
BATCHES = T.StructType([_s("batch_date", T.DateType(), False), _s("report_date", T.DateType(), False)])
