"""tripweave — trips enriched with places and hourly weather, on Spark.

The library reads trip records, a zone lookup and hourly weather
observations, cleans and joins them into one wide ``rides`` table, and
computes the dashboard measures over it.  Every step is a DataFrame
transformation: Catalyst plans the scans, joins and aggregations.
"""

from tripweave.session import get_session, ensure_checkpoint_dir, scratch_path

__all__ = ["get_session", "ensure_checkpoint_dir", "scratch_path"]
