"""Specifications of feature families and their hashes.

A specification identifies a set of features; the functions compute the default set, whatever the specification. All
families are rows of one table, from which their classes, checks and serialised forms follow.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field, make_dataclass
from decimal import Decimal
from enum import Enum
from typing import Any, NamedTuple

from tidemark.types import FEATURE_NAMES


def _other(value: Any) -> Any:
    """What JSON has no form for: enumerations by value, all else as text; numbers must be finite."""
    if isinstance(value, Decimal) and not value.is_finite():
        raise ValueError(f"a specification holds {value}")
    return value.value if isinstance(value, Enum) else str(value)


def compact(value: Any) -> str:
    """JSON without spaces, keys sorted: the same text for equal values. A float that isn't finite is a ValueError."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), allow_nan=False, default=_other)


def canonical(value: Any) -> Any:
    """A value as it comes back from its JSON."""
    return json.loads(compact(value))


class Identified:
    """What the SHA-256 of a dictionary's JSON identifies."""

    def canonical_dict(self) -> dict[str, Any]:
        raise NotImplementedError

    @property
    def spec_hash(self) -> str:
        return hashlib.sha256(compact(self.canonical_dict()).encode()).hexdigest()


class Bound(NamedTuple):
    """What a value must be, and the error where it isn't."""

    says: str
    holds: Callable[[Any], bool]
    error: type[Exception] = ValueError

    def check(self, name: str, value: Any) -> None:
        if not self.holds(value):
            raise self.error(f"{name} must be {self.says}, got {value!r}")


def _number(value: Any, *kinds: type) -> bool:
    return isinstance(value, kinds) and not isinstance(value, bool)


INTEGER = Bound("an int", lambda v: _number(v, int), TypeError)
COUNT = Bound("a positive whole number", lambda v: _number(v, int) and v > 0)
COUNTS = Bound("positive whole numbers", lambda v: all(map(COUNT.holds, v)))
FILLED = Bound("a non-empty tuple", lambda v: isinstance(v, tuple) and v != (), TypeError)
SWITCH = Bound("a bool", lambda v: isinstance(v, bool), TypeError)
POSITIVE = Bound("a positive number", lambda v: _number(v, int, float) and v > 0)
BIT = Bound("0 or 1", lambda v: _number(v, int, float) and v in (0, 1))
SHARE = Bound("from 0 to 1", lambda v: isinstance(v, int | float) and 0 <= v <= 1)
NAME = Bound("a non-empty string", lambda v: isinstance(v, str) and v.strip() != "")
MAPPING = Bound("a dict", lambda v: isinstance(v, dict), TypeError)

# The version of every family and of the whole set, and the families' parameters with their defaults,
# as they enter the hash. The bounds of a parameter follow its default.
FAMILY_VERSION = "1.0.0"
SET_VERSION = "2.3.0"
PARAMETERS = {
    "trend": {
        "ema_periods": ((20, 50, 200), COUNTS),
        "source": ("close",),
        "smoothing": ("exponential",),
        "seed_convention": ("sma",),
        "slope_k": (3, COUNT),
        "warmup_multiplier": (3, COUNT),
    },
    "momentum": {
        "rsi_period": (14, COUNT),
        "source": ("close",),
        "smoothing": ("wilder",),
        "seed_convention": ("sma",),
        "macd_fast": (12, COUNT),
        "macd_slow": (26, COUNT),
        "macd_signal": (9, COUNT),
        "roc_periods": ((10, 21),),
        "warmup_multiplier": (3,),
    },
    "volatility": {
        "atr_period": (14, COUNT),
        "smoothing": ("wilder",),
        "bb_period": (20, COUNT),
        "bb_std_mult": (2.0, POSITIVE),
        "ddof": (0, BIT),
        "warmup_multiplier": (3,),
    },
    "volume": {
        "volume_sma_period": (20, COUNT),
        "rvol_period": (20, COUNT),
        "seed_convention": ("sma",),
        "neutral_taker_share": (0.5, SHARE),
    },
    "price_structure": {
        "pivot_k": (2, INTEGER, COUNT),
        "strict_inequality": (True, SWITCH),
        "range_periods": ((20, 50), FILLED, COUNTS),
    },
}
#: Parameters of which the first must be below the second.
RISING = {"momentum": [("macd_fast", "macd_slow")]}
#: Serialised values that follow from parameters.
DERIVED: dict[str, dict[str, Callable[[Any], Any]]] = {"price_structure": {"window_size": lambda family: 2 * family.pivot_k + 1}}


@dataclass(frozen=True)
class FeatureSpec(Identified):
    """A named, versioned set of parameters."""

    name: str
    version: str = FAMILY_VERSION
    params: dict[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for what, bound in (("name", NAME), ("version", NAME), ("params", MAPPING)):
            bound.check(what, getattr(self, what))

    def canonical_dict(self) -> dict[str, Any]:
        return canonical({"name": self.name.strip(), "version": self.version.strip(), "params": self.params})


class Family:
    """A family's parameters, held to the bounds of its row in PARAMETERS."""

    row: str

    def __post_init__(self) -> None:
        for param, (_, *bounds) in PARAMETERS[self.row].items():
            for bound in bounds:
                bound.check(param, getattr(self, param))
        for low, high in RISING.get(self.row, ()):
            if getattr(self, low) >= getattr(self, high):
                raise ValueError(f"{low} must be less than {high}")

    def to_feature_spec(self) -> FeatureSpec:
        """Serialised: a parameter whose default is a float is one, and tuples are lists."""
        plain = {float: float, tuple: list}
        params = {p: plain.get(type(default), lambda v: v)(getattr(self, p)) for p, (default, *_) in PARAMETERS[self.row].items()}
        return FeatureSpec(self.name, self.version, params | {p: of(self) for p, of in DERIVED.get(self.row, {}).items()})


def _family(title: str, row: str) -> type:
    """The frozen class of a row: name, version, and a field for each parameter."""
    own = [("name", str, row), ("version", str, FAMILY_VERSION), *((p, type(d), d) for p, (d, *_) in PARAMETERS[row].items())]
    return make_dataclass(title, [(n, kind, field(default=d)) for n, kind, d in own], bases=(Family,), namespace={"row": row}, frozen=True, module=__name__)


TrendSpec = _family("TrendSpec", "trend")
MomentumSpec = _family("MomentumSpec", "momentum")
VolatilitySpec = _family("VolatilitySpec", "volatility")
VolumeSpec = _family("VolumeSpec", "volume")
#: Pivots over 2 * pivot_k + 1 bars; no function computes them.
StructureSpec = _family("StructureSpec", "price_structure")


@dataclass(frozen=True)
class TechnicalFeaturesSpec(Identified):
    """The families whose features the matrix holds."""

    trend: Family = TrendSpec()
    momentum: Family = MomentumSpec()
    volatility: Family = VolatilitySpec()
    volume: Family = VolumeSpec()
    version: str = SET_VERSION

    def family_specs(self) -> dict[str, FeatureSpec]:
        return {name: value.to_feature_spec() for name, value in vars(self).items() if isinstance(value, Family)}

    def canonical_dict(self) -> dict[str, Any]:
        families = {name: spec.canonical_dict() for name, spec in self.family_specs().items()}
        return canonical({"version": self.version, "feature_names": FEATURE_NAMES, "families": families})
