"""Column-expression helpers (no DataFrame actions)."""

from .bins import (  # noqa: F401
    band_of,
    histogram_bin,
    label_bin,
    linspace_probs,
    lit_array,
    percent_grid_probs,
    width_bin,
)
from .nulls import NA_TOKENS, nan_to_null, to_double  # noqa: F401
