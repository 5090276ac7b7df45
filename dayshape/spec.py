"""Column roles.

Every operator takes a DataFrame and, where it needs more than one column, a ``Spec`` that says
which column plays which role. Nothing else in the package knows a concrete column name.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Spec:
    entity: str
    slot: str
    measure: str
    klass: str
    period: str
    date: str
    code: str
    region: str
    region_name: str
    authority: str
    components: tuple[str, ...] = ()
    main_component: str | None = None
    required: tuple[str, ...] = ()
    attributes: tuple[str, ...] = ()
    coordinates: tuple[str, ...] = ()
    major_classes: tuple[str, ...] = ()
    slot_range: tuple[int, int] = (7, 18)
    min_measure: float = 0
    barred: Mapping[str, str] = field(default_factory=dict, hash=False)


@dataclass(frozen=True)
class Split:
    """Train on periods up to ``train_until``; test from ``test_from`` (to ``test_until``)."""

    name: str
    train_until: int
    test_from: int
    test_until: int | None = None


@dataclass(frozen=True)
class FeatureSet:
    categorical: tuple[str, ...]
    numeric: tuple[str, ...]

    @property
    def names(self) -> tuple[str, ...]:
        return self.categorical + self.numeric


# Why a column in a role may not be a feature.
BARRED_ROLES = {
    "measure": "it is what is forecast",
    "observed": "it is measured along with the measure, so it isn't known beforehand",
    "derived": "it is worked out from the measure",
    "period": "it tells training from test",
    "identity": "it names entities and says nothing of new ones",
    "proxy": "another column already says it",
}


def barred(**roles: tuple[str, ...]) -> dict[str, str]:
    """Columns that may not be features, from the roles they play, each with the role's reason."""
    return {column: BARRED_ROLES[role] for role, columns in roles.items() for column in columns}
