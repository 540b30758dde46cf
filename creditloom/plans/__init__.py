from creditloom.plans import (
    application_peers,
    bureau,
    credit_card,
    instalments,
    pos_cash,
    previous_applications,
)

__all__ = [
    "application_peers",
    "bureau",
    "credit_card",
    "instalments",
    "pos_cash",
    "previous_applications",
]
