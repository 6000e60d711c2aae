"""DataFrame operators: dimensions and facts, type-2 history, fraud rules,
data-quality checks, the report sink and a skew-safe lag."""

from vigil.operators.dims import (
    Bank,
    build_bank,
    card_holders,
    dim_accounts,
    dim_cards,
    dim_clients,
    fact_blacklist,
    fact_transactions,
    with_holder,
)
from vigil.operators.history import (
    apply_snapshot,
    changed_terminals,
    current_terminals,
    deleted_terminals,
    history_from_snapshot,
    new_terminals,
)
from vigil.operators.quality import duplicate_keys, orphans
from vigil.operators.report import fraud_report, write_report
from vigil.operators.rules import (
    account_cheat,
    all_rules,
    amount_cheat,
    amount_hits,
    amount_sequence,
    batch_list,
    city_cheat,
    city_hits,
    city_sequence,
    expiry_rules,
    flagged_clients,
    expired_accounts,
    passport_cheat,
    terminal_cities,
)
from vigil.operators.seqlag import hot_groups, lag_columns

__all__ = [
    "Bank", "build_bank", "card_holders", "dim_accounts", "dim_cards", "dim_clients",
    "fact_blacklist", "fact_transactions", "with_holder", "apply_snapshot", "changed_terminals",
    "current_terminals", "deleted_terminals", "history_from_snapshot", "new_terminals",
    "duplicate_keys", "orphans", "fraud_report", "write_report", "account_cheat", "all_rules",
    "amount_cheat", "amount_hits", "batch_list", "city_cheat", "city_hits",
    "flagged_clients", "expired_accounts", "passport_cheat", "hot_groups", "lag_columns",
    "amount_sequence", "city_sequence", "terminal_cities", "expiry_rules",
]
