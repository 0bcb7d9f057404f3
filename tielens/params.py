"""Run parameters. Operators never read a clock or an environment: what varies by run or deployment is here."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    today: str = "2001-08-15"
    event_day: str = "2024-02-01"
    run_ms: int = 1706745600000
    owned_emails: tuple[str, ...] = ("owner@example.com", "owner@example.org")
    owned_domains: tuple[str, ...] = ("example.com",)
    family_surnames: tuple[str, ...] = ("garcía",)
    cohort: tuple[str, str] = ("2026-07-22 14:00:00", "2026-07-22 14:02:00")
    dry_run: bool = True
    weights: dict[str, int] = field(default_factory=dict)

    @property
    def run_id(self) -> str:  # the prefix is a fixed value of the id format
        return f"LATE-EDITION-{self.run_ms}"


PARAMS = Params()
