"""Description of a panel: which columns identify a row and what they mean."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from .functions import fixed_values as fixed
from .functions.frames import History
from .functions.periods import MONTH

ROLES = tuple(fixed.BANK_ROLES)


@dataclass(frozen=True)
class PanelSpec:
    """One row per entity and period.

    ``roles`` maps the roles of :data:`ROLES` to the panel's own column names, e.g.
    ``{"spend_a": "visa_spend"}``.  ``granularity`` is ``"month"`` for YYYYMM periods and
    ``"index"`` for periods that count up by one.
    """

    id: str
    period: str
    target: str = "target"
    granularity: str = MONTH
    roles: dict[str, str] = field(default_factory=dict)

    @property
    def key(self) -> list[str]:
        return [self.id, self.period]

    @property
    def history(self) -> History:
        return History(self.id, self.period)

    def role(self, name: str) -> str:
        try:
            return self.roles[name]
        except KeyError:
            raise KeyError(f"panel has no column for the role {name!r}") from None

    def with_roles(self, **roles: str) -> "PanelSpec":
        return replace(self, roles={**self.roles, **roles})


#: The bank panel with its usual column names.
BANK_PANEL = PanelSpec(**fixed.BANK_KEY, roles=dict(fixed.BANK_ROLES))
