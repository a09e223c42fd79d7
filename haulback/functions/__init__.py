from .classes import assign_group, left_closed_class, length_class, sector_of, tonnage_class
from .dates import in_years, parse_dmy
from .positions import decode_packed
from .trips import blank_to_empty, observed_flag
from .weights import cod_had_ratio, floor_zero, pollock_dominant, safe_ratio, zero_if_null

__all__ = [
    "assign_group", "left_closed_class", "length_class", "sector_of", "tonnage_class",
    "in_years", "parse_dmy", "decode_packed", "blank_to_empty", "observed_flag",
    "cod_had_ratio", "floor_zero", "pollock_dominant", "safe_ratio", "zero_if_null",
]
