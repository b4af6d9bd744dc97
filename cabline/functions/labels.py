"""Code-to-label maps for the wide table.

Anything not in a map, NULL included, becomes ``OTHER``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Must equal the published code books.
OTHER = "Other"

VENDOR_NAMES = {
    1: "Creative Mobile Technologies",
    2: "Curb Mobility",
    6: "Myle Technologies",
    7: "Helix",
}

RATE_CODE_DESCRIPTIONS = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau/Westchester",
    5: "Negotiated fare",
    6: "Group ride",
}

PAYMENT_TYPE_DESCRIPTIONS = {
    0: "Flex Fare trip",
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}


def label(code: Column, mapping: dict[int, str], other: str = OTHER) -> Column:
    """``CASE code WHEN k THEN v ... ELSE other END`` as one codegen'd expression."""
    expr = None
    for k, v in mapping.items():
        expr = F.when(code == F.lit(k), F.lit(v)) if expr is None else expr.when(code == F.lit(k), F.lit(v))
    return F.lit(other) if expr is None else expr.otherwise(F.lit(other))
