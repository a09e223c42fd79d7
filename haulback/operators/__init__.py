from .attributes import ATTRIBUTES, Attributes, landing_attributes, narrowed
from .bootstrap import bootstrap_ratio, ratio_of_ratios, ratio_rows
from .cleaning import (
    add_cod_had_verdict, all_sets_fail_trips, early_failing_sets, failing_last_sets, flag_directed,
    flag_out_of_scope, kept, mark_trips, remove_cod_directed, remove_no_panel, remove_noncommercial, remove_other_sought,
    remove_pollock_directed, removed_audit, trip_reasons, trip_set_listing, trip_verdicts,
)
from .coverage import (
    add_group, aggregate_trips, coverage, coverage_cells, coverage_summary, coverage_tiers, group_landings,
    split_fully_covered, ungrouped_counts,
)
from .discards import allocate_discards, check_allocation, estimate_discards
from .keys import anti_by, left_join_on_trip, semi_by, split_by
from .landings import assign_sector, landings, landings_crosstab, narrow_landings, trip_codes
from .observer import observer_trips, separator_panels, sought_species
from .reconcile import (
    first_per_vessel_day, landing_error_list, landing_errors, landing_errors_incorrect, landing_errors_missing, landed_days, match_table,
    observer_check, observer_missing, reconcile,
)
from .zones import (
    assign_zone, fleet_positions, fleet_trips, identify_zone, observer_position, parse_positions, positions_between,
    vessel_day_mean_position,
)

__all__ = [name for name in dir() if not name.startswith("_")]
