"""The 21 vault models as data."""

from __future__ import annotations

from ledgerloom.operators.specs import (
    Attribute,
    Hub,
    Link,
    PointInTime,
    Role,
    Satellite,
    Status,
)
from ledgerloom.sources.tables import SNAPSHOT_AT

CUSTOMER = Hub("hub_customer", "customers", "customer_id", "customer_hk")
ACCOUNT = Hub("hub_account", "accounts", "account_id", "account_hk")
TRANSACTION = Hub("hub_transaction", "transactions", "transaction_id", "transaction_hk")
GL_ACCOUNT = Hub("hub_gl_account", "gl_accounts", "gl_account_code", "gl_account_hk")
JOURNAL_ENTRY = Hub(
    "hub_journal_entry", "journal_entries", "journal_entry_id", "journal_entry_hk"
)

HUBS = {hub.name: hub for hub in (CUSTOMER, ACCOUNT, TRANSACTION, GL_ACCOUNT, JOURNAL_ENTRY)}


def _role(hub: Hub) -> Role:
    return Role(hub.key, hub.hash_key)


# The only link read from the captures: ownership changes, and past owners stay.
CUSTOMER_ACCOUNT = Link(
    "link_customer_account",
    "accounts",
    (_role(CUSTOMER), _role(ACCOUNT)),
    "customer_account_hk",
    seen_at=SNAPSHOT_AT,
)
POSTING_GL = Link(
    "link_journal_posting_gl",
    "journal_postings",
    (_role(JOURNAL_ENTRY), _role(GL_ACCOUNT)),
    "journal_posting_gl_hk",
    child="posting_id",
)

LINKS = {
    link.name: link
    for link in (
        CUSTOMER_ACCOUNT,
        Link(
            "link_transaction_source_account",
            "transactions",
            (_role(TRANSACTION), _role(ACCOUNT)),
            "transaction_source_account_hk",
        ),
        Link(
            "link_transaction_destination_account",
            "transactions",
            (_role(TRANSACTION), Role("destination_account_id", "destination_account_hk")),
            "transaction_destination_account_hk",
            not_blank=("destination_account_id",),
        ),
        Link(
            "link_transaction_gl_account",
            "transactions",
            (_role(TRANSACTION), _role(GL_ACCOUNT)),
            "transaction_gl_account_hk",
        ),
        Link(
            "link_journal_entry_transaction",
            "journal_entries",
            (_role(JOURNAL_ENTRY), _role(TRANSACTION)),
            "journal_entry_transaction_hk",
        ),
        Link(
            "link_journal_posting_account",
            "journal_postings",
            (_role(JOURNAL_ENTRY), _role(ACCOUNT)),
            "journal_posting_account_hk",
            child="posting_id",
        ),
        POSTING_GL,
    )
}

# Attribute order is part of the change hash.
CUSTOMER_DETAILS = Satellite(
    "sat_customer_details",
    "customers",
    CUSTOMER,
    "customer_id",
    (Attribute("first_name"), Attribute("last_name"), Attribute("created_at", as_text=True)),
)
ACCOUNT_DETAILS = Satellite(
    "sat_account_details",
    "accounts",
    ACCOUNT,
    "account_id",
    (
        Attribute("iban"),
        Attribute("currency"),
        Attribute("status"),
        Attribute("opened_at", as_text=True),
    ),
)

SATELLITES = {
    satellite.name: satellite
    for satellite in (
        CUSTOMER_DETAILS,
        ACCOUNT_DETAILS,
        Satellite(
            "sat_transaction_details",
            "transactions",
            TRANSACTION,
            "transaction_id",
            (
                Attribute("transaction_type"),
                Attribute("amount", as_text=True),
                Attribute("currency"),
                Attribute("status"),
                Attribute("booking_date", as_text=True),
                Attribute("created_at", as_text=True),
            ),
        ),
        Satellite(
            "sat_gl_account_details",
            "gl_accounts",
            GL_ACCOUNT,
            "gl_account_code",
            (Attribute("account_name"), Attribute("account_category"), Attribute("is_active")),
        ),
        Satellite(
            "sat_journal_entry_details",
            "journal_entries",
            JOURNAL_ENTRY,
            "journal_entry_id",
            (Attribute("posting_date", as_text=True), Attribute("status")),
        ),
        # Amounts hang on the posting's ledger relationship; a posting has no hub of its own.
        Satellite(
            "sat_journal_posting_amount",
            "journal_postings",
            POSTING_GL,
            "posting_id",
            (
                Attribute("debit_amount", as_text=True),
                Attribute("credit_amount", as_text=True),
            ),
        ),
    )
}

CUSTOMER_ACCOUNT_STATUS = Status("sts_customer_account", CUSTOMER_ACCOUNT)

POINTS_IN_TIME = {
    pit.name: pit
    for pit in (
        PointInTime("pit_customer", CUSTOMER, CUSTOMER_DETAILS, "sat_customer_load_dts"),
        PointInTime("pit_account", ACCOUNT, ACCOUNT_DETAILS, "sat_account_load_dts"),
    )
}
