"""Guest keys and loyalty bands."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LoyaltyBands:
    """Labels by days since the previous visit, first matching limit wins."""

    first_visit: str
    limits: Sequence[tuple[int, str]]
    beyond: str

    def label(self, visit_number: Column, gap_days: Column) -> Column:
        ladder = F.when(visit_number == 1, self.first_visit)
        for days, name in self.limits:
            ladder = ladder.when(gap_days <= days, name)
        return ladder.otherwise(self.beyond)


# Labels and limits of the loyalty segments.
SEGMENT_BANDS = LoyaltyBands(
    first_visit="New Guest",
    limits=((7, "High-Frequency Loyal"), (30, "Standard Returning")),
    beyond="Churned / Reactivated Guest",
)

# Only the limits are given for guests known by id; the labels name the band.
CUSTOMER_BANDS = LoyaltyBands(
    first_visit="New Guest",
    limits=((30, "<=30d"), (90, "<=90d"), (180, "<=180d")),
    beyond=">180d",
)


def segment_key() -> Column:
    """Pseudo-guest: payment method, city and venue type hashed together.

    ``concat`` has no separator and is NULL as soon as one part is.
    """
    return F.md5(F.concat("payment_method", "city", "venue_type"))
