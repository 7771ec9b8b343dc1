"""Column roles of a feature table."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Roles:
    """Which column plays which part; every operator takes its columns from here."""

    numerical: tuple[str, ...]
    categorical: tuple[str, ...]
    target: str
    key: str | None = None
    date: str | None = None
    passthrough: tuple[str, ...] = field(default=())

    @property
    def required(self) -> list[str]:
        return [*self.numerical, *self.categorical, self.target]

    @property
    def features(self) -> list[str]:
        return [*self.categorical, *self.numerical]
