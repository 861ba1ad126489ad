"""Incremental processing of trip files as they arrive (Structured Streaming)."""

from tripweave.streaming.incremental import start_incremental_rides, trip_hash_id

__all__ = ["start_incremental_rides", "trip_hash_id"]
