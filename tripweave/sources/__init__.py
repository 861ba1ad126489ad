"""Readers for the three pipeline inputs and for published outputs."""

from tripweave.sources.files import (
    InputMissingError, read_trips, read_zones, read_observations, write_csv,
    require_inputs, infer_schema, set_split_size,
)
from tripweave.sources.byname import load_by_name

__all__ = [
    "InputMissingError", "read_trips", "read_zones", "read_observations",
    "write_csv", "require_inputs", "infer_schema", "set_split_size", "load_by_name",
]
