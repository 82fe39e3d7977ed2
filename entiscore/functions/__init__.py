"""Column-expression building blocks (flags, ramps, bands, scaled scores)."""

from entiscore.functions.measures import (  # noqa: F401
    bands,
    category_score,
    inverse_square_sum,
    minmax_scaled,
    no_neg_zero,
    non_empty,
    ramp,
    rank_weighted_sum,
)
