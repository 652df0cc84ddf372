"""Column-level functions."""

from quakeframe.functions.columns import (
    class1_probability,
    energy_release,
    epoch_ms_to_timestamp,
    epoch_seconds,
    grid_index,
    risk_level,
    threshold_label,
)

__all__ = [
    "class1_probability",
    "energy_release",
    "epoch_ms_to_timestamp",
    "epoch_seconds",
    "grid_index",
    "risk_level",
    "threshold_label",
]
