"""Named sources of records."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any


class SourceRegistry:
    """Builders of source tables by name; a name can be taken once."""

    def __init__(self) -> None:
        self._known: dict[str, tuple[str, Callable[..., Any]]] = {}

    def register(self, name: str, kind: str, build: Callable[..., Any]) -> None:
        if name in self._known:
            raise ValueError(f"source {name} is registered already")
        self._known[name] = (kind, build)

    def names(self) -> list[str]:
        return sorted(self._known)

    def kind(self, name: str) -> str:
        return self._known[name][0]

    def get(self, name: str) -> Callable[..., Any]:
        return self._known[name][1]


def default_sources() -> SourceRegistry:
    from .sources import directories, programs, workforce

    out = SourceRegistry()
    for name, kind, build in (
        ("usagov", "organization_directory", directories.agency_index), ("federal_register", "organization_directory", directories.agency_list),
        ("govinfo_govman", "organization_directory", directories.manual_details), ("opm_fwd", "workforce_organization_hierarchy", workforce.workforce_records),
        ("fpi", "program_inventory", directories.inventory), ("sam_assistance", "program_inventory", programs.listings_from_table),
        ("treasury_tax_expenditures", "tax_expenditure_inventory", programs.tax_expenditures), ("performance_fpi_archive", "historical_program_inventory", programs.archive_from_table),
        ("supplemental", "program_inventory", programs.supplement_from_table), ("uscode_authority", "statutory_authority", programs.enrich_authorities),
    ):
        out.register(name, kind, build)
    return out
