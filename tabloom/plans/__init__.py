"""Plan shapes that keep work distributed where a built-in would use one task."""

from tabloom.plans.blocks import running_total, with_blocks
from tabloom.plans.neighbours import with_neighbours
from tabloom.plans.quantiles import exact_quantiles, kth_smallest
from tabloom.plans.sizing import attach, pinned_if_small

__all__ = [
    "attach",
    "exact_quantiles",
    "kth_smallest",
    "pinned_if_small",
    "running_total",
    "with_blocks",
    "with_neighbours",
]
