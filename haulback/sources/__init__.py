from .csv_tables import check_landings_csv, read_landings_csv, read_results_csv, write_report
from .reports import publish_reports, read_reports
from .tables import LandingTables, ObserverTables, read_tables
from .zones import zone_index, zones_from_vertices

__all__ = [
    "LandingTables", "ObserverTables", "read_tables", "check_landings_csv", "read_landings_csv", "read_results_csv",
    "write_report", "publish_reports", "read_reports", "zone_index", "zones_from_vertices",
]
