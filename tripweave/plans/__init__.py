"""End-to-end plans: build the rides table, publish it, backfill by month."""

from tripweave.plans.rides import build_rides

__all__ = ["build_rides"]
