"""What changes from year to year and from stock to stock."""

from __future__ import annotations

from dataclasses import dataclass, field

from ..functions.classes import GROUP_RULES, SECTOR_CODES
from ..functions.weights import COD_HAD_THRESHOLD
from ..operators.bootstrap import REPLICATES, SAMPLE_SIZE, SEED
from ..operators.cleaning import TARGET_SPECIES
from ..operators.coverage import LONGLINE_GEAR
from ..operators.landings import AREA_IDS
from ..operators.observer import AREA_PREFIX, EXCLUDED_GEARS


@dataclass(frozen=True)
class Settings:
    """Rules and parameters of one run; the defaults are the customary ones.

    ``areas`` are the area ids of the landings, ``area_prefix`` begins the observer's area codes,
    ``observer_gears_excluded`` are not fishing gears of the stock, ``gear_excluded`` is left out of
    the roll-up (None: no gear is). ``target_species`` may be sought without removing a trip.
    ``group_rules`` are ``(label, sectors, quarters or None, zones or None)``, the first match wins.
    """

    areas: list[int] = field(default_factory=lambda: list(AREA_IDS))
    sector_codes: dict[int, list[int]] = field(default_factory=lambda: dict(SECTOR_CODES))
    group_rules: list[tuple] = field(default_factory=lambda: list(GROUP_RULES))
    cod_had_threshold: float = COD_HAD_THRESHOLD
    area_prefix: str = AREA_PREFIX
    observer_gears_excluded: list[int] = field(default_factory=lambda: list(EXCLUDED_GEARS))
    gear_excluded: int | None = LONGLINE_GEAR
    target_species: list[int] = field(default_factory=lambda: list(TARGET_SPECIES))
    tolerance_days: int = 2
    trust_observer: bool = True
    one_match: bool = False
    replicates: int = REPLICATES
    sample_size: int = SAMPLE_SIZE
    seed: int = SEED
