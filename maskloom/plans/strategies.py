"""The strategy registry: rule vocabulary -> Column expressions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskloom.functions import accounts, generalize, identity

ROW, CROSS_ROW, ROTATE, KEEP = "row", "crossrow", "rotate", "keep"


class MaskError(Exception):
    """A rule that cannot be carried out."""


@dataclass(frozen=True)
class Target:
    """The column a strategy is applied to; ``nested`` where the value may stand inside a lambda, which runs no Python."""

    value: Column
    dtype: T.DataType
    name: str
    row_key: Column
    salt: str = ""
    params: dict = field(default_factory=dict)
    nested: bool = False

    @property
    def seed_text(self) -> Column:
        """The text that picks the fake; ``normalize`` lets differently typed copies agree."""
        text = self.value.cast("string")
        return F.lower(F.trim(text)) if self.params.get("normalize") == "lower_trim" else text


@dataclass(frozen=True)
class Strategy:
    name: str
    kind: str
    apply: Callable[[Target], Column] | None = None
    accepts: Callable[[T.DataType], bool] = lambda dtype: True


def _is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.CharType, T.VarcharType))


def _is_number(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def _is_time(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))


def _null(target: Target) -> Column:
    return F.lit(None).cast(target.dtype)


def _from_seed(fake: Callable[..., Column], apart: Callable[[Target], Column] | None = None) -> Callable[[Target], Column]:
    """``unique: true`` in a rule keeps different values apart, for columns used as keys.

    ``apart`` is how, where the fake has a form of its own; other fakes get a digest.
    """

    def apply(target: Target) -> Column:
        if not target.params.get("unique"):
            return fake(target.seed_text, salt=target.salt)
        if apart is not None:
            return apart(target)
        return identity.told_apart(fake(target.seed_text, salt=target.salt), target.seed_text, target.salt)

    return apply


def _same_form(tag: str) -> Callable[[Target], Column]:
    return lambda target: accounts.unique_text(target.seed_text, tag, target.salt, target.nested)


def _format_preserving(fake: Callable[..., Column], apart: Callable[..., Column] | None = None) -> Callable[[Target], Column]:
    def apply(target: Target) -> Column:
        if apart is not None and target.params.get("unique"):
            return apart(target.value, seed_text=target.seed_text, salt=target.salt, nested=target.nested)
        return fake(target.value, seed_text=target.seed_text, salt=target.salt)

    return apply


_REGISTRY: dict[str, Strategy] = {}


def register_strategy(
    name: str,
    apply: Callable[[Target], Column] | None,
    kind: str = ROW,
    accepts: Callable[[T.DataType], bool] | None = None,
) -> None:
    """Add or replace a strategy. ``apply`` turns a :class:`Target` into a Column."""
    _REGISTRY[name] = Strategy(name, kind, apply, accepts or (lambda dtype: True))


def strategy(name: str) -> Strategy:
    try:
        return _REGISTRY[name]
    except KeyError:
        raise MaskError(f"strategy {name!r} has no implementation; see register_strategy()") from None


def is_registered(name: str) -> bool:
    return name in _REGISTRY


register_strategy("keep", None, KEEP)
register_strategy("drop", _null)
register_strategy("null_binary", _null)
register_strategy("fake_person_name", _from_seed(identity.fake_person_name), accepts=_is_text)
register_strategy("fake_company_name", _from_seed(identity.fake_company_name), accepts=_is_text)
register_strategy("fake_email", _from_seed(identity.fake_email), accepts=_is_text)
register_strategy("fake_phone", _from_seed(identity.fake_phone, _same_form("phone:")), accepts=_is_text)
register_strategy("fake_street_address", _from_seed(identity.fake_street_address), accepts=_is_text)
register_strategy("fake_city", _from_seed(identity.fake_city), accepts=_is_text)
register_strategy("fake_zip", _from_seed(identity.fake_zip, _same_form("zip:")), accepts=_is_text)
register_strategy("fake_vat", _format_preserving(accounts.fake_vat), accepts=_is_text)
register_strategy("fake_iban", _format_preserving(accounts.fake_iban, accounts.unique_iban), accepts=_is_text)
register_strategy("fake_bank_account_number", _format_preserving(accounts.fake_bank_account, accounts.unique_bank_account), accepts=_is_text)
register_strategy(
    "partial_keep_last4",
    lambda t: generalize.partial_keep_last4(t.value),
    accepts=_is_text,
)
register_strategy("generalize_year", lambda t: generalize.generalize_year(t.value, t.dtype), accepts=_is_time)
register_strategy(
    "generalize_numeric_band",
    lambda t: generalize.numeric_band(
        t.value, t.row_key, t.name, t.dtype, float(t.params.get("ratio", generalize.BAND_RATIO)), t.salt
    ),
    accepts=_is_number,
)
register_strategy("redact_freetext", lambda t: generalize.redact_text(t.value), accepts=_is_text)
register_strategy("shuffle_within_column", None, CROSS_ROW)
register_strategy("rotate_secret", None, ROTATE)
