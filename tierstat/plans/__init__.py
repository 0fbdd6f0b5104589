from tierstat.plans.absence_location import AbsenceLocation, absence_location_school
from tierstat.plans.compare_report import compare_report
from tierstat.plans.region_performance import RegionPerformance, region_performance

__all__ = [
    "AbsenceLocation",
    "RegionPerformance",
    "absence_location_school",
    "compare_report",
    "region_performance",
]
