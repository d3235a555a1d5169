"""Thresholds in one place; overrides replace single values."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Thresholds:
    """Defaults of the reports. Unknown names in an override fail, so a typo is not silently ignored."""

    coverage_mismatch_ratio: float = 3.0
    edition_page_tolerance: float = 0.1
    edition_year_tolerance: int = 1
    edition_classifier_version: str = "v1"
    appendix_misclassified_min: int = 2
    consensus_min_origins: int = 3
    base_source_guard: float = 0.2
    weight_l1_bib: float = 30
    weight_l2_toc: float = 40
    weight_l3_body: float = 30
    rich_min_depth: int = 2
    rich_min_nodes: int = 5
    overlap: float = 0.6

    def override(self, **values) -> Thresholds:
        known = {f.name for f in fields(self)}
        if unknown := set(values) - known:
            raise ValueError(f"unknown thresholds: {sorted(unknown)}")
        return replace(self, **values)

    def classifier(self) -> str:
        """v2 on request; anything unknown is v1."""
        return "v2" if self.edition_classifier_version == "v2" else "v1"
