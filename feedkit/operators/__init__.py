"""DataFrame -> DataFrame operators composed by the feeds."""

from feedkit.operators.asof import asof_cumulative, asof_join
from feedkit.operators.changes import changed_since, exclude_same_year, latest_activity, not_sent
from feedkit.operators.control import CatalogControl, ControlTable, control_source, upsert_control
from feedkit.operators.latest import at_max, latest_per_key, max_per_key, preferred
from feedkit.operators.periods import (collect_one, current_period, floor_period, next_period,
                                       run_params, year_of)
from feedkit.operators.render import (data_rows, header_frame, render_delimited, render_quoted,
                                      with_header)
from feedkit.operators.rules import band_match, code_flags, presence_flag, rules_with_attributes
from feedkit.operators.shape import (apply_override, first_available, ordered_list, pivot_first,
                                     season_winner, union_cohorts, with_rows)

__all__ = [
    "asof_cumulative", "asof_join", "changed_since", "exclude_same_year",
    "latest_activity", "not_sent", "CatalogControl", "ControlTable", "control_source", "upsert_control", "at_max",
    "latest_per_key", "max_per_key", "preferred", "collect_one", "current_period", "floor_period",
    "next_period", "run_params", "year_of", "data_rows", "header_frame", "render_delimited",
    "render_quoted", "with_header", "band_match", "code_flags", "presence_flag",
    "rules_with_attributes", "apply_override", "first_available", "ordered_list", "pivot_first",
    "season_winner", "union_cohorts", "with_rows",
]
