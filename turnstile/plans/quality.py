"""The checks that guard the models, and the validation of the sources."""

from ..fixed import (
    CHANNELS,
    RANGE_END,
    RANGE_START,
    SELLER_ORGANIZER,
    SELLER_RESELLER,
    SOURCE_PLATFORM,
    SOURCE_VENDOR,
    SYSTEM_DATABASE,
    SYSTEM_FILES,
)
from ..operators.checks import (
    Check,
    accepted,
    bad_rows,
    nonempty,
    not_null,
    related,
    related_through,
    unique,
)

# Which columns of which model must be unique or present, which
# values they may take, and which column points to which model.
UNIQUE = {
    "stg_customers": ["customer_id", "email"],
    "stg_events": ["event_id"],
    "stg_organizers": ["organizer_id"],
    "stg_resellers": ["reseller_id"],
    "stg_commissions": ["agreement_id"],
    "stg_ticket_sales": ["ticket_id"],
    "stg_reseller_daily_sales": ["transaction_id"],
    "int_sales_transactions": ["sales_id"],
    "dim_customer": ["customer_id"],
    "dim_event": ["event_id"],
    "dim_organizer": ["organizer_id"],
    "dim_reseller": ["reseller_id"],
    "dim_date": ["date_key"],
}
NOT_NULL = {
    "stg_customers": [
        "customer_id", "email", "first_name", "last_name", "source_system",
        "batch_id", "load_ts", "updated_at",
    ],
    "stg_events": [
        "event_id", "organizer_id", "event_name", "event_type", "event_date",
        "venue", "region",
    ],
    "stg_organizers": ["organizer_id", "organizer_name", "region"],
    "stg_resellers": ["reseller_id", "reseller_name", "country", "region"],
    "stg_commissions": [
        "agreement_id", "organizer_id", "reseller_id", "commission_rate",
        "effective_from",
    ],
    "stg_ticket_sales": [
        "ticket_id", "sales_channel", "quantity", "unit_price", "total_amount",
        "purchase_date",
    ],
    "stg_reseller_daily_sales": [
        "transaction_id", "reseller_id", "source_file_name",
        "customer_first_name", "customer_last_name", "total_amount",
        "created_date",
    ],
    "int_sales_transactions": [
        "sales_id", "seller_type", "sales_channel", "sales_source",
        "source_system", "quantity", "unit_price", "total_amount", "sales_date",
    ],
    "dim_customer": ["customer_id"],
    "dim_event": ["event_id"],
    "dim_organizer": ["organizer_id"],
    "dim_reseller": ["reseller_id"],
    "dim_date": ["date_key"],
    "fact_ticket_sales": ["event_id", "sales_date", "quantity", "total_amount"],
}
ACCEPTED = [
    ("stg_ticket_sales", "sales_channel", CHANNELS),
    ("int_sales_transactions", "seller_type", [SELLER_ORGANIZER, SELLER_RESELLER]),
    ("int_sales_transactions", "sales_source", [SOURCE_PLATFORM, SOURCE_VENDOR]),
    ("int_sales_transactions", "source_system", [SYSTEM_DATABASE, SYSTEM_FILES]),
]
RELATED = [
    ("stg_events", "organizer_id", "stg_organizers"),
    ("stg_commissions", "organizer_id", "stg_organizers"),
    ("stg_commissions", "reseller_id", "stg_resellers"),
    ("stg_ticket_sales", "customer_id", "stg_customers"),
    ("stg_ticket_sales", "reseller_id", "stg_resellers"),
    ("stg_ticket_sales", "event_id", "stg_events"),
    ("stg_reseller_daily_sales", "reseller_id", "stg_resellers"),
    ("int_sales_transactions", "reseller_id", "stg_resellers"),
    ("fact_ticket_sales", "customer_id", "dim_customer"),
    ("fact_ticket_sales", "event_id", "dim_event"),
    ("fact_ticket_sales", "reseller_id", "dim_reseller"),
    ("fact_ticket_sales", "organizer_id", "dim_organizer"),
]


def model_checks(*tables: str, as_of: str = "current_date()") -> list[Check]:
    """Checks of the named models, or of all; ``as_of`` is a SQL date."""
    checks = [unique(t, c) for t, cs in UNIQUE.items() for c in cs]
    checks += [not_null(t, c) for t, cs in NOT_NULL.items() for c in cs]
    checks += [accepted(*a) for a in ACCEPTED]
    checks += [related(t, c, p, c) for t, c, p in RELATED]
    sales = "int_sales_transactions"
    checks += [
        bad_rows("no_negative_sales_amount", sales, "total_amount < 0"),
        bad_rows("no_zero_or_negative_quantity", sales, "quantity <= 0"),
        bad_rows("purchase_date_not_future", sales, f"sales_date > {as_of}"),
        bad_rows(
            "commission_rate_valid",
            "stg_commissions",
            "commission_rate < 0 OR commission_rate > 100 OR commission_rate IS NULL",
        ),
    ]
    return [c for c in checks if not tables or c.table in tables]


def source_checks(start: str = RANGE_START, end: str = RANGE_END) -> list[Check]:
    """Validation of the six source tables before anything is loaded.

    Here null keys count as broken references, and equal nulls as duplicates.
    """
    names = [
        "organizers", "resellers", "commission_agreements", "events", "customers",
        "ticket_sales",
    ]
    keys = {
        "organizers": "organizer_id", "resellers": "reseller_id",
        "events": "event_id", "customers": "customer_id",
        "ticket_sales": "ticket_id",
    }
    sales = "ticket_sales"
    return [
        *[nonempty(t) for t in names],
        *[unique(t, k, nulls=True) for t, k in keys.items()],
        related("events", "organizer_id", "organizers", "organizer_id", True),
        related("commission_agreements", "organizer_id", "organizers", "organizer_id", True),
        related("commission_agreements", "reseller_id", "resellers", "reseller_id", True),
        related(sales, "event_id", "events", "event_id", True),
        related(sales, "customer_id", "customers", "customer_id", True),
        related(sales, "reseller_id", "resellers", "reseller_id", True),
        # A reseller sells only for organizers it has an agreement with. The organizer
        # is the event's, and a sale without reseller has no agreement.
        related_through(sales, "event_id", "events", "organizer_id", "reseller_id",
                        "commission_agreements"),
        bad_rows("event_date_range", "events",
                 f"event_date < DATE'{start}' OR event_date > DATE'{end}'"),
        bad_rows("purchase_date_range", sales,
                 f"purchase_date < DATE'{start}' OR purchase_date > DATE'{end}'"),
        bad_rows("commission_rate_range", "commission_agreements",
                 "commission_rate < 0 OR commission_rate > 100"),
        bad_rows("quantity_positive", sales, "quantity <= 0"),
        bad_rows("unit_price_positive", sales, "unit_price <= 0"),
        accepted(sales, "sales_channel", CHANNELS, null_passes=False),
        bad_rows("amount_matches", sales,
                 "round(quantity * unit_price, 2) <> total_amount"),
        *[not_null(sales, c) for c in ("event_id", "customer_id", "reseller_id")],
    ]
