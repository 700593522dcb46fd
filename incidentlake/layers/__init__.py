"""Versioned layers: whole replacement by a commit of a few bytes."""

from incidentlake.layers.footers import FooterCounts, footer_counts
from incidentlake.layers.versions import (
    Manifest,
    commit_layer,
    current_version,
    drop_old_versions,
    is_versioned,
    read_version,
    versions,
)

__all__ = [
    "FooterCounts",
    "Manifest",
    "commit_layer",
    "current_version",
    "drop_old_versions",
    "footer_counts",
    "is_versioned",
    "read_version",
    "versions",
]
