"""Voidage-replacement analytics as set-based Spark DataFrame operators."""

from voidage.plans.pvt import pvt_lookup, requests_by_factor, requests_by_volume
from voidage.plans.vrr import vrr_report, vrr_view

__all__ = [
    "pvt_lookup",
    "requests_by_factor",
    "requests_by_volume",
    "vrr_report",
    "vrr_view",
]
