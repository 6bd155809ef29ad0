"""Names and settings of the credit-risk data model."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

ENTITY_KEY = "SK_ID_CURR"
TARGET = "TARGET"
BASE_TABLE = "application_train"
EXCLUDED_FROM_FEATURES = ("TARGET", "_DW_ID", "SK_ID_PREV", "SK_ID_BUREAU")
MIN_CATEGORY_FREQUENCY = 10
PREVIEW_MODELS = ("xgboost", "tabpfn_mix", "pyod_autoencoder")

# Child tables of the feature table by feature prefix.
FEATURE_TABLES: Mapping[str, Mapping[str, str]] = {
    "bureau": {"table": "bureau", "key": "SK_ID_CURR"},
    "bureau_balance": {
        "table": "bureau_balance", "bridge": "bureau", "bridge_key": "SK_ID_BUREAU", "key": "SK_ID_CURR",
    },
    "previous": {"table": "previous_application", "key": "SK_ID_CURR"},
    "credit_card": {"table": "credit_card_balance", "key": "SK_ID_CURR"},
    "installments": {"table": "installments_payments", "key": "SK_ID_CURR"},
    "pos_cash": {"table": "pos_cash_balance", "key": "SK_ID_CURR"},
}

# Shared dimensions, value to id.
SHARED_MAPPINGS: list[dict[str, dict[str, int]]] = [
    {"name_contract_type": {"Cash loans": 1, "Consumer loans": 2, "Revolving loans": 3, "XNA": 4}},
    {
        "name_type_suite": {
            "Children": 1, "Family": 2, "Group of people": 3, "Other_A": 4, "Other_B": 5,
            "Spouse, partner": 6, "Unaccompanied": 7,
        }
    },
    {
        "weekday_appr_process_start": {
            "MONDAY": 1, "TUESDAY": 2, "WEDNESDAY": 3, "THURSDAY": 4, "FRIDAY": 5, "SATURDAY": 6, "SUNDAY": 7,
        }
    },
    {
        "name_contract_status": {
            "Active": 1, "Amortized debt": 2, "Approved": 3, "Canceled": 4, "Completed": 5, "Demand": 6,
            "Refused": 7, "Returned to the store": 8, "Sent proposal": 9, "Signed": 10, "Unused offer": 11,
            "XNA": 12,
        }
    },
]


def settings(**changes: Any) -> dict[str, Any]:
    """Job settings with changes applied."""
    base = {
        "entity_key": ENTITY_KEY, "target": TARGET, "base_table": BASE_TABLE,
        "feature_tables": FEATURE_TABLES, "exclude": EXCLUDED_FROM_FEATURES,
        "min_frequency": MIN_CATEGORY_FREQUENCY, "test_size": 0.2, "validation_size": 0.2, "seed": 42,
    }
    return {**base, **changes}
