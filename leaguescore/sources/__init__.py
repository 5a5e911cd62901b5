"""Scans of parquet and CSV data, roster sheets and timestamped snapshots."""

from leaguescore.sources.scans import scan_csv, scan_parquet
from leaguescore.sources.sheets import (
    check_sheet_columns,
    read_picks,
    scan_sheets,
    sheet_inventory,
    sheets_from_headers,
)
from leaguescore.sources.snapshots import (
    latest_snapshot,
    list_snapshots,
    read_latest,
    snapshot_freshness,
    snapshot_manifest,
)

__all__ = [
    "check_sheet_columns",
    "latest_snapshot",
    "list_snapshots",
    "read_latest",
    "read_picks",
    "scan_csv",
    "scan_parquet",
    "scan_sheets",
    "sheet_inventory",
    "sheets_from_headers",
    "snapshot_freshness",
    "snapshot_manifest",
]
