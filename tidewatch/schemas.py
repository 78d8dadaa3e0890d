"""Column contracts of the tables that the library passes around."""

from __future__ import annotations

#: Columns of raw files, of transactions and of rule hits.
RAW_COLUMNS = ["timestamp", "from_bank", "account", "to_bank", "account_1", "amount_received", "receiving_currency", "amount_paid", "payment_currency", "payment_format", "is_laundering"]
STANDARD = "transaction_id long, timestamp timestamp, from_bank string, to_bank string, sender_account_id string, receiver_account_id string, amount_paid double, amount_received double, payment_currency string, receiving_currency string, payment_format string, currency_pair string, cross_bank_flag int, amount double, log_amount double, is_laundering int"
RULE_HITS = "rule_hit_id string, transaction_id long, alert_timestamp timestamp, rule_id string, rule_name string, severity string, trigger_values_json string, threshold_json string, rationale string, is_laundering int, split string"
STANDARD_COLUMNS = [c.split(" ")[0] for c in STANDARD.split(", ")]
RULE_HIT_COLUMNS = [c.split(" ")[0] for c in RULE_HITS.split(", ")]

#: Rules in their order, with names, default status and severity.
RULES = [
    ("R1_AMOUNT", "Segmented high amount", "escalation"),
    ("R2_NOVELTY", "New counterparty / cross-bank novelty", "coverage"),
    ("R3_VELOCITY", "Velocity / structuring", "escalation"),
    ("R4_PASS_THROUGH", "Rapid pass-through", "escalation"),
    ("R5_FAN_IN", "Fan-in concentration", "escalation"),
    ("R6_FAN_OUT", "Fan-out / gather-scatter-lite", "escalation"),
]
RULE_IDS = [r[0] for r in RULES]
SEVERITY = {"low": 1, "medium": 2, "high": 3, "critical": 4}
SPLITS = ["train", "validation", "test"]
BANDS = ["P1", "P2", "P3", "P4"]
