"""leaguescore: rule-driven scoring of league statistics on Spark.

Every function takes frames and returns a frame, lazily, but for ``measured``
dimensions (one small aggregate each), ``consolidate`` in its raising mode, and
the sinks.
"""

from leaguescore.functions import in_seasons, nan_to_null
from leaguescore.operators.joins import Dimension, measured
from leaguescore.operators.quality import (
    audit_counts,
    audited,
    contract_violations,
    new_audits,
    sheet_violations,
)
from leaguescore.plans.bonuses import defense_bonus, offense_bonus, plays
from leaguescore.plans.dimensions import players, teams
from leaguescore.plans.report import (
    League,
    all_scored_stats,
    league_report,
    scored_report,
    sorted_report,
)
from leaguescore.plans.rosters import SheetViolation, consolidate, measured_picks
from leaguescore.plans.stats import kicker_stats, offense_stats, points_allowed
from leaguescore.sinks import (
    ContractViolation,
    publish,
    read_published,
    write_csv,
    write_parquet,
    write_picks,
)
from leaguescore.sources import (
    latest_snapshot,
    read_latest,
    read_picks,
    scan_csv,
    scan_parquet,
    scan_sheets,
    sheet_inventory,
    sheets_from_headers,
    snapshot_freshness,
    snapshot_manifest,
)

__all__ = [
    "ContractViolation",
    "Dimension",
    "League",
    "SheetViolation",
    "all_scored_stats",
    "audit_counts",
    "audited",
    "consolidate",
    "contract_violations",
    "defense_bonus",
    "in_seasons",
    "kicker_stats",
    "latest_snapshot",
    "league_report",
    "measured",
    "measured_picks",
    "nan_to_null",
    "new_audits",
    "offense_bonus",
    "offense_stats",
    "players",
    "plays",
    "points_allowed",
    "publish",
    "read_latest",
    "read_picks",
    "read_published",
    "scan_csv",
    "scan_parquet",
    "scan_sheets",
    "scored_report",
    "sheet_inventory",
    "sheet_violations",
    "sheets_from_headers",
    "snapshot_freshness",
    "snapshot_manifest",
    "sorted_report",
    "teams",
    "write_csv",
    "write_parquet",
    "write_picks",
]
