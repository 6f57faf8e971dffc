"""Declared table layouts. Nothing is ever inferred from the data.

Layouts are plain ``{column: type}`` dicts, so that they can be stated without a
running session and turned into a DDL string where Spark wants one.
"""

from __future__ import annotations

from dataclasses import dataclass

Layout = dict[str, str]


def ddl(layout: Layout) -> str:
    """``{"a": "int"}`` -> ``"`a` int"``, as accepted by readers and ``from_json``."""
    return ", ".join(f"`{name}` {kind}" for name, kind in layout.items())


# Column names and types of the wire payloads and tables.

PAYMENT_EVENT: Layout = {
    "event_id": "string",
    "event_type": "string",
    "timestamp": "timestamp",
    "transaction_id": "string",
    "account_id": "string",
    "amount": "double",
    "currency": "string",
    "channel": "string",
    "merchant_category": "string",
    "status": "string",
    "city": "string",
    "country": "string",
    "latitude": "double",
    "longitude": "double",
    "is_international": "boolean",
    "customer_tier": "string",
    "risk_score": "double",
}

# One layout for the two signal topics; a field a message lacks reads as NULL.
SIGNAL_EVENT: Layout = {
    "event_id": "string",
    "event_type": "string",
    "timestamp": "timestamp",
    "account_id": "string",
    "fraud_type": "string",
    "ml_score": "double",
    "rule_triggers": "array<string>",
    "action": "string",
    "case_id": "string",
    "alert_type": "string",
    "risk_band": "string",
    "sar_required": "boolean",
    "total_amount_7d": "double",
    "channel": "string",
    "auth_method": "string",
    "login_success": "boolean",
    "new_device": "boolean",
}

EVENT_KEY_COLUMNS = ("event_id", "event_type", "timestamp", "account_id")
FRAUD_COLUMNS = (*EVENT_KEY_COLUMNS, "fraud_type", "ml_score", "rule_triggers", "action", "case_id", "event_date")
AML_COLUMNS = (*EVENT_KEY_COLUMNS, "alert_type", "risk_band", "sar_required", "total_amount_7d", "event_date")
CUSTOMER_EVENT_COLUMNS = (*EVENT_KEY_COLUMNS, "channel", "auth_method", "login_success", "new_device", "event_date")

PAYMENT_WINDOW: Layout = {
    "window_start": "timestamp",
    "window_end": "timestamp",
    "city": "string",
    "channel": "string",
    "merchant_category": "string",
    "txn_count": "bigint",
    "total_amount": "double",
    "avg_amount": "double",
    "max_amount": "double",
    "approved_count": "bigint",
    "declined_count": "bigint",
    "intl_count": "bigint",
    "avg_risk_score": "double",
    "event_date": "date",
}

# What a stream read and put into no event table, with the message itself.
REJECTED_EVENT: Layout = {
    "stream": "string",
    "outcome": "string",
    "event_id": "string",
    "event_type": "string",
    "message": "string",
    "ingested_at": "timestamp",
    "event_date": "date",
}

_SIGNAL_TYPES = {**SIGNAL_EVENT, "event_date": "date"}

EVENT_LAYOUTS: dict[str, Layout] = {
    "payment_transactions": {**PAYMENT_EVENT, "ingested_at": "timestamp", "event_date": "date"},
    "payment_agg": PAYMENT_WINDOW,
    "fraud_alerts": {c: _SIGNAL_TYPES[c] for c in FRAUD_COLUMNS},
    "aml_alerts": {c: _SIGNAL_TYPES[c] for c in AML_COLUMNS},
    "customer_events": {c: _SIGNAL_TYPES[c] for c in CUSTOMER_EVENT_COLUMNS},
    "rejected_events": REJECTED_EVENT,
}

EVENT_PARTITIONS: dict[str, tuple[str, ...]] = {
    "payment_transactions": ("event_date", "city"),
    "payment_agg": ("event_date", "city"),
    "fraud_alerts": ("event_date", "fraud_type"),
    "aml_alerts": ("event_date", "risk_band"),
    "customer_events": ("event_date",),
    "rejected_events": ("event_date", "outcome"),
}

EVENT_TABLES: dict[str, tuple[str, ...]] = {name: tuple(layout) for name, layout in EVENT_LAYOUTS.items() if name != "rejected_events"}

CUSTOMER_MASTER: Layout = {
    "customer_id": "string",
    "account_id": "string",
    "full_name": "string",
    "national_id_masked": "string",
    "date_of_birth": "date",
    "age_group": "string",
    "gender": "string",
    "email": "string",
    "mobile_number_masked": "string",
    "city": "string",
    "province": "string",
    "country": "string",
    "postal_code": "string",
    "customer_tier": "string",
    "occupation": "string",
    "annual_income": "decimal(14,2)",
    "risk_rating": "string",
    "kyc_status": "string",
    "pep_flag": "boolean",
    "sanctions_screening_status": "string",
    "account_open_date": "date",
    "preferred_channel": "string",
    "marketing_consent": "boolean",
    "created_at": "timestamp",
    "updated_at": "timestamp",
}

ACCOUNT_FILE: Layout = {
    "account_id": "string",
    "customer_tier": "string",
    "city": "string",
    "country": "string",
}

BATCH_STAMP: Layout = {
    "source_system": "string",
    "batch_id": "string",
    "ingested_at": "timestamp",
}


@dataclass(frozen=True)
class Target:
    """A table kept by keyed upserts.

    ``ordering`` guards against older versions of a row; ``watermark`` is the
    column whose maximum says how far earlier runs got.
    """

    table: str
    keys: tuple[str, ...]
    layout: Layout
    partition_by: tuple[str, ...] = ()
    ordering: str | None = None
    watermark: str | None = None

    def __post_init__(self) -> None:
        stray = {*self.keys, *self.partition_by, self.ordering, self.watermark} - {None} - set(self.layout)
        if stray:
            raise ValueError(f"{self.table}: not among its columns: {sorted(stray)}")

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(self.layout)


_CUSTOMER_SOURCE = {c: t for c, t in CUSTOMER_MASTER.items() if c not in ("created_at", "updated_at")}

DIM_CUSTOMER = Target(
    table="dim_customer",
    keys=("customer_id",),
    layout={**_CUSTOMER_SOURCE, "src_created_at": "timestamp", "src_updated_at": "timestamp", **BATCH_STAMP},
    ordering="src_updated_at",
    watermark="src_updated_at",
)

DIM_ACCOUNT = Target(
    table="dim_account",
    keys=("account_id",),
    layout={**ACCOUNT_FILE, "source_file": "string", "src_updated_at": "timestamp", **BATCH_STAMP},
    ordering="src_updated_at",
)

FACT_PAYMENT_DAILY = Target(
    table="fact_payment_daily",
    keys=("event_date", "account_id"),
    layout={
        "event_date": "date",
        "account_id": "string",
        "txn_count": "bigint",
        "total_amount": "double",
        "avg_amount": "double",
        "max_amount": "double",
        "approved_count": "bigint",
        "declined_count": "bigint",
        "intl_count": "bigint",
        "avg_risk_score": "double",
        "first_txn_at": "timestamp",
        "last_txn_at": "timestamp",
        **BATCH_STAMP,
    },
    partition_by=("event_date",),
    watermark="last_txn_at",
)

REJECTED_LINES = Target(
    table="rejected_lines",
    keys=("batch_id", "source"),
    layout={"batch_id": "string", "source": "string", "source_file": "string", "reason": "string", "line": "string"},
)

RUN_LOG = Target(
    table="ingestion_audit",
    keys=("batch_id", "source"),
    layout={
        "batch_id": "string",
        "source": "string",
        "target_table": "string",
        "mode": "string",
        "watermark": "timestamp",
        "rows_read": "bigint",
        "rows_inserted": "bigint",
        "rows_updated": "bigint",
        "snapshot_id": "bigint",
        "started_at": "timestamp",
        "finished_at": "timestamp",
        "duration_sec": "double",
        "status": "string",
        "message": "string",
    },
)
