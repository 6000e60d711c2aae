"""Dimensions, facts and card-holder enrichment.

The dimension builds are projections with renames; the card-holder
enrichment is a chain of n:1 left joins card -> account -> client. Join
strategies between dimensions are left to the optimizer: with adaptive
execution a side that is small at run time is broadcast, anything else is a
shuffled join, so no dimension is ever broadcast on the assumption that it is
small; there are no hints.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions import date_lit, full_name
from vigil.session import written


@dataclass(frozen=True)
class Bank:
    """The three bank dimensions (warehouse shape)."""

    clients: DataFrame
    accounts: DataFrame
    cards: DataFrame


# --- dimension and fact builds (projections) -------------------------------

def dim_clients(seed: DataFrame) -> DataFrame:
    return seed.select("client_id", "last_name", "first_name", "patronymic", "date_of_birth",
                       "passport_num", "passport_valid_to", "phone", "create_dt", "update_dt")


def dim_accounts(seed: DataFrame) -> DataFrame:
    return seed.select(F.col("account").alias("account_num"), "valid_to", "client",
                       "create_dt", "update_dt")


def dim_cards(seed: DataFrame) -> DataFrame:
    return seed.select("card_num", F.col("account").alias("account_num"), "create_dt",
                       "update_dt")


def build_bank(seed_clients: DataFrame, seed_accounts: DataFrame, seed_cards: DataFrame) -> Bank:
    return Bank(dim_clients(seed_clients), dim_accounts(seed_accounts), dim_cards(seed_cards))


def _batch_column(df: DataFrame, batch_date: dt.date | Column | None) -> Column:
    if batch_date is None:
        if "batch_date" not in df.columns:
            raise ValueError("batch_date is neither a column nor given")
        return F.col("batch_date")
    if isinstance(batch_date, Column):
        return batch_date
    return date_lit(batch_date)


def fact_transactions(staged: DataFrame, batch_date: dt.date | Column | None = None) -> DataFrame:
    """Staged transaction rows -> fact rows, tagged with their batch date."""
    return staged.select(
        F.col("transaction_id").alias("trans_id"),
        F.col("transaction_date").alias("trans_date"),
        F.col("amount").alias("amt"),
        "card_num", "oper_type", "oper_result", "terminal",
        _batch_column(staged, batch_date).alias("batch_date"),
    )


def fact_blacklist(staged: DataFrame, batch_date: dt.date | Column | None = None) -> DataFrame:
    """Staged blacklist rows -> fact rows, tagged with their batch date."""
    return staged.select(
        F.col("passport").alias("passport_num"),
        F.col("date").alias("entry_dt"),
        _batch_column(staged, batch_date).alias("batch_date"),
    )


# --- card holders ----------------------------------------------------------

def _holder_parts(bank: Bank) -> tuple[DataFrame, DataFrame, DataFrame]:
    cards = bank.cards.select("card_num", "account_num")
    accounts = bank.accounts.select("account_num", F.col("client").alias("client_id"))
    clients = bank.clients.select(
        "client_id", "passport_num", "phone",
        full_name("last_name", "first_name", "patronymic").alias("fio"))
    return cards, accounts, clients


def card_holders(bank: Bank) -> DataFrame:
    """One row per card with its account, client, full name, passport and phone."""
    cards, accounts, clients = _holder_parts(bank)
    return (cards.join(accounts, "account_num", "left")
            .join(clients, "client_id", "left")
            .select("card_num", "account_num", "client_id", "fio", "passport_num", "phone"))


def with_holder(df: DataFrame, holders: Bank | DataFrame) -> DataFrame:
    """Add ``fio``, ``passport_num`` and ``phone`` of the card holder to rule
    hits carrying ``card_num`` (left join: unknown cards keep null columns).

    ``holders`` is the bank (card holders are derived) or a stored
    ``card_holders`` table. Hits are few; the holder side is as large as the
    card base. The hits are written once, so their size in bytes is known: when
    it is below Spark's limit, their distinct card keys are broadcast into a semi
    join that filters the holder side map-side, and the card base is scanned but
    never shuffled for a handful of hits; above it the joins are shuffle joins.
    """
    table = card_holders(holders) if isinstance(holders, Bank) else holders
    table = table.select("card_num", "fio", "passport_num", "phone")
    hits = written(df)
    keys = hits.select("card_num").filter(F.col("card_num").isNotNull()).distinct()
    return hits.join(table.join(keys, "card_num", "left_semi"), "card_num", "left")
