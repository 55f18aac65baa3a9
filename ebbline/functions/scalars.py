"""Scalar helpers (SC1-SC24)."""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Loan product descriptions and the group each is reported under.
PRODUCT_GROUPS: dict[str, list[str]] = {
    "first home purchase": [
        "Home Deposit",
        "Buy home - established (1st buyer)",
        "Buy Home - new (1st buyer)",
        "Home Construction (1st buyer)",
    ],
    "home Purchase": [
        "Buy Home - established (not 1st buyer)",
        "Buy Home - New (not first buyer)",
        "Home Construction (not 1st buyer)",
        "Purchase Land",
        "Purchase and Construct",
        "Residential Freehold Torrens Title",
        "Purchase Dwelling",
    ],
    "refinancing - house": ["Refinance Home Mortgage", "Home Improvements"],
    "refinancing - living expenses": [
        "Holiday Expenses",
        "Medical Expenses",
        "Dental Expenses",
        "Education Expenses",
        "Pay Tax",
    ],
    "refinancing - debt management": ["Debt Consolidation", "Debt Minimization"],
    "refinancing - vehicle": [
        "Purchase Vehicle - Used",
        "Purchase motor cycle",
        "Purchase Trailer",
        "Purchase Vehicle - NEW",
        "Motor Vehicle Expenses",
    ],
    "refinancing - personal": [
        "Substitution of Security Extra Funds",
        "Line of Credit",
        "Property Settlement",
        "Property Transfer",
        "Legal Fees",
        "Wedding Expenses",
        "Travel Requirements",
        "Household Items",
        "Miscellaneous",
        "Recreation Expenses",
        "Purchase boat",
        "Purchase Caravan",
    ],
    "business": [
        "Buy Commerical R/E",
        "Business Capital",
        "Purchase Shares",
        "Wealth Creation",
        "Buy Home Investment",
    ],
}


def remap(value: Column, groups: Mapping[str, Sequence[str]]) -> Column:
    """Name of the group that lists ``value``, else ``value`` itself (SC1)."""
    branches = [(value.isin(list(names)), F.lit(group)) for group, names in groups.items()]
    first, *rest = branches
    case = reduce(lambda acc, b: acc.when(*b), rest, F.when(*first))
    return case.otherwise(value)


def ratio(a: Column, b: Column) -> Column:
    """a / b as double, NULL when b is zero or either side is NULL (SC4, SC5)."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def relative_change(now: Column, before: Column) -> Column:
    return ratio(now - before, before)


def greatest_or_null(*cols: Column) -> Column:
    """GREATEST that is NULL as soon as one input is (SC20)."""
    return F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in cols]), F.greatest(*cols))


def least_or_null(*cols: Column) -> Column:
    """LEAST that is NULL as soon as one input is (SC20)."""
    return F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in cols]), F.least(*cols))


def bucket_label(value: Column, width: int) -> Column:
    """Label such as ``100000-149999`` (SC17)."""
    low = (F.floor(value / F.lit(width)) * width).cast("bigint")
    return F.concat(low.cast("string"), F.lit("-"), (low + (width - 1)).cast("string"))


def no_nan(value: Column) -> Column:
    """NaN to NULL."""
    return F.when(~F.isnan(value), value)
