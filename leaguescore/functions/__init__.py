"""Column expressions with the missing-value rules of the data model."""

from leaguescore.functions.columns import (
    differs,
    exact_long,
    fill_zero,
    floor_div,
    is_not,
    not_in,
    player_label,
    recode,
    short_owner,
    team_label,
    true_if_missing,
)
from leaguescore.functions.frames import (
    add_constants,
    in_seasons,
    nan_to_null,
    rename_checked,
)

__all__ = [
    "add_constants",
    "differs",
    "exact_long",
    "fill_zero",
    "floor_div",
    "in_seasons",
    "is_not",
    "nan_to_null",
    "not_in",
    "player_label",
    "recode",
    "rename_checked",
    "short_owner",
    "team_label",
    "true_if_missing",
]
