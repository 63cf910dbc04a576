"""Fresh random values for rotated secrets.

They never read the old value and differ on every evaluation. Write a rotated table once and read
it back; never evaluate it twice and expect the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fresh_uuid() -> Column:
    return F.uuid()


def fresh_secret() -> Column:
    """64 hex characters from two random uuids."""
    return F.concat(F.md5(F.uuid()), F.md5(F.uuid()))


FRESH = {"uuid": fresh_uuid, "secret": fresh_secret, "token": fresh_secret}
