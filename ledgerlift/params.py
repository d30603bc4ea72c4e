"""Run parameters shared by every plan."""

from dataclasses import dataclass


@dataclass(frozen=True)
class RunParams:
    """Company and fiscal year of a run, used as literals in the plans.

    ``block_size`` is the number of item codes one subgroup can hold before a
    new subgroup is opened.  ``direct_bid_years`` is how many years before the
    fiscal year tenders without bidding rounds are taken from.
    """

    company: int
    fiscal_year: int
    block_size: int = 1000
    direct_bid_years: int = 6
