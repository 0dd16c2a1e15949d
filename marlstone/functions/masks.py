"""What a caller may see of one value, given the groups the caller is in.

Groups are known when the query is built, so each mask is decided there and
Catalyst sees a plain column or a constant, never a per-row membership test.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Defaults: group names and the region granted to the BI group.  Fixed values: mask texts.
ENGINEERS = "engineers"
ANALYSTS = "analysts"
BI_READER = "bi_reader"
BI_REGION = "TX"
EMAIL_MASK = "***@***.***"
PII_MASK = "***REDACTED-PII***"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def mask_email(email: Column | str, groups: Iterable[str]) -> Column:
    """Engineers see the address, others its first two letters; NULL stays NULL."""
    email = _col(email)
    if ENGINEERS in set(groups):
        return email
    return F.concat(F.left(email, F.lit(2)), F.lit(EMAIL_MASK))


def mask_tagged_pii(value: Column | str, groups: Iterable[str]) -> Column:
    """Engineers see the value, others a constant (also in place of NULL)."""
    return _col(value) if ENGINEERS in set(groups) else F.lit(PII_MASK)


def region_visible(state: Column | str, groups: Iterable[str], region: str = BI_REGION) -> Column:
    """Row predicate: engineers and analysts all rows, the BI group one region."""
    held = set(groups)
    if held & {ENGINEERS, ANALYSTS}:
        return F.lit(True)
    if BI_READER in held:
        return _col(state) == region
    return F.lit(False)
