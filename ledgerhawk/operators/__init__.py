"""Relational operators of the warehouse load and the fraud report."""

from .audit import audit_fact, audit_scd1, audit_scd2
from .quality import (
    domain_violations,
    duplicate_keys,
    history_violations,
    null_violations,
    numeric_violations,
    orphans,
    width_violations,
)
from .rules import (
    amount_probes,
    amount_sequence,
    busy_cards,
    card_profile,
    city_hops,
    city_sequence,
    enrich,
    expiry_flags,
    fraud_report,
    rule_amount_probe,
    rule_city_hop,
    rule_expired_account,
    rule_expired_passport,
)
from .scd import (
    anti_null_aware,
    current,
    hist_as_of,
    insert_missing,
    collapse_scd1,
    scd1_backfill,
    scd1_chain,
    scd1_from_history,
    scd1_upsert,
    scd1_upsert_literal,
    scd2_backfill,
    scd2_merge,
    scd2_merge_literal,
    scd2_step,
    version_chain,
    with_day_validity,
)
from .sequence import exact_lag
from .staging import stage, variants

__all__ = [n for n in dir() if not n.startswith("_")]
