"""Category vocabularies for one-hot encoding.

Fixed values: these must equal the category texts found in the input tables, and they fix the
names and the order of the flag columns.
"""

from __future__ import annotations

PREVIOUS_CONTRACT_STATUS = ("Approved", "Canceled", "Refused", "Unused offer")
CONTRACT_TYPE = ("Cash loans", "Consumer loans", "Revolving loans", "XNA")
CHANNEL_TYPE = (
    "AP+ (Cash loan)",
    "Car dealer",
    "Channel of corporate sales",
    "Contact center",
    "Country-wide",
    "Credit and cash offices",
    "Regional / Local",
    "Stone",
)
TYPE_SUITE = (
    "Children",
    "Family",
    "Group of people",
    "Other_A",
    "Other_B",
    "Spouse, partner",
    "Unaccompanied",
)
YIELD_GROUP = ("XNA", "high", "low_action", "low_normal", "middle")
PRODUCT_COMBINATION = (
    "Card Street",
    "Card X-Sell",
    "Cash",
    "Cash Street: high",
    "Cash Street: low",
    "Cash Street: middle",
    "Cash X-Sell: high",
    "Cash X-Sell: low",
    "Cash X-Sell: middle",
    "POS household with interest",
    "POS household without interest",
    "POS industry with interest",
    "POS industry without interest",
    "POS mobile with interest",
    "POS mobile without interest",
    "POS other with interest",
    "POS others without interest",
)
PRODUCT_TYPE = ("XNA", "walk-in", "x-sell")
CLIENT_TYPE = ("New", "Refreshed", "Repeater", "XNA")

#: Column -> categories of the previous-application table, in flag order.
PREVIOUS_APPLICATION: dict[str, tuple[str, ...]] = {
    "NAME_CONTRACT_STATUS": PREVIOUS_CONTRACT_STATUS,
    "NAME_CONTRACT_TYPE": CONTRACT_TYPE,
    "CHANNEL_TYPE": CHANNEL_TYPE,
    "NAME_TYPE_SUITE": TYPE_SUITE,
    "NAME_YIELD_GROUP": YIELD_GROUP,
    "PRODUCT_COMBINATION": PRODUCT_COMBINATION,
    "NAME_PRODUCT_TYPE": PRODUCT_TYPE,
    "NAME_CLIENT_TYPE": CLIENT_TYPE,
}

CARD_CONTRACT_STATUS = (
    "Active",
    "Approved",
    "Completed",
    "Demand",
    "Refused",
    "Sent proposal",
    "Signed",
)
POS_CONTRACT_STATUS = (
    "Active",
    "Amortized debt",
    "Approved",
    "Canceled",
    "Completed",
    "Demand",
    "Returned to the store",
    "Signed",
    "XNA",
)

CREDIT_ACTIVE = ("Active", "Bad debt", "Closed", "Sold")
CREDIT_CURRENCY = ("currency 1", "currency 2", "currency 3", "currency 4")
CREDIT_TYPE = (
    "Another type of loan",
    "Car loan",
    "Cash loan (non-earmarked)",
    "Consumer credit",
    "Credit card",
    "Interbank credit",
    "Loan for business development",
    "Loan for purchase of shares (margin lending)",
    "Loan for the purchase of equipment",
    "Loan for working capital replenishment",
    "Microloan",
    "Mobile operator loan",
    "Mortgage",
    "Real estate loan",
    "Unknown type of loan",
)

#: Column -> categories of the bureau table, in flag order.
BUREAU: dict[str, tuple[str, ...]] = {
    "CREDIT_ACTIVE": CREDIT_ACTIVE,
    "CREDIT_CURRENCY": CREDIT_CURRENCY,
    "CREDIT_TYPE": CREDIT_TYPE,
}

#: Monthly payment status of a bureau loan.
MONTHLY_STATUS = ("0", "1", "2", "3", "4", "5", "C", "X")

#: Day offset that stands for "no date" in the DAYS_* columns.
DAYS_SENTINEL = 365243
