from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vigil.operators.dims import Bank  # noqa: E402
from vigil.schemas import (  # noqa: E402
    DIM_ACCOUNTS,
    DIM_CARDS,
    DIM_CLIENTS,
    FACT_BLACKLIST,
    FACT_TRANSACTIONS,
    TERMINALS_HIST,
    TERMINALS_SNAPSHOT,
)
from vigil.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="vigil-test-ckpt-")
    catalog = tempfile.mkdtemp(prefix="vigil-test-warehouse-")
    s = get_session("local[4]", app="vigil-tests", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": ckpt, "spark.sql.warehouse.dir": catalog})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def D(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def T(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def make_bank(spark, clients, accounts, cards) -> Bank:
    """clients: (client_id, last, first, middle, passport, passport_valid_to, phone);
    accounts: (account_num, valid_to, client); cards: (card_num, account_num)."""
    cl = [(c[0], c[1], c[2], c[3], None, c[4], c[5], c[6], None, None) for c in clients]
    ac = [(a[0], a[1], a[2], None, None) for a in accounts]
    ca = [(c[0], c[1], None, None) for c in cards]
    return Bank(spark.createDataFrame(cl, DIM_CLIENTS), spark.createDataFrame(ac, DIM_ACCOUNTS),
                spark.createDataFrame(ca, DIM_CARDS))


def make_facts(spark, rows, batch_date=D("2021-03-01")):
    """rows: (trans_id, trans_date, amt, card_num, oper_type, oper_result, terminal)."""
    full = [tuple(r) + (batch_date,) if len(r) == 7 else tuple(r) for r in rows]
    return spark.createDataFrame(full, FACT_TRANSACTIONS)


def make_blacklist(spark, rows, batch_date=D("2021-03-01")):
    return spark.createDataFrame([(p, d, batch_date) for p, d in rows], FACT_BLACKLIST)


def make_snapshot(spark, rows):
    return spark.createDataFrame(rows, TERMINALS_SNAPSHOT)


def make_hist(spark, rows):
    """rows: (terminal_id, type, city, address, deleted_flg, from, to)."""
    return spark.createDataFrame([(None,) + tuple(r) for r in rows], TERMINALS_HIST)


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))
