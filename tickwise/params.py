"""Model parameters (the reference keeps them as project variables)."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Params:
    vol_window: int = 21          # rows in the rolling volatility frame
    beta_window: int = 252        # rows in the rolling beta frame
    benchmark: str = "^BVSP"      # symbol used as the market benchmark
    annualisation: int = 252      # trading days per year
    start_date: str = "2019-01-01"  # fallback start of an incremental load
    min_pair_obs: int = 20        # least common days for a pair correlation
    segmented: bool = False       # windows over segments: for histories that no task can hold
    segment_rows: int = 500_000   # rows of one symbol that a segmented window task holds
    segment_days: int = 32        # calendar days of the buckets that segments are made of
    pair_blocks: int | None = None  # symbol blocks for the all-pairs join (None: sized by data)
    pair_gram: bool = True          # pair moments by matrix products in Arrow batches
    pair_block_symbols: int = 128   # symbols per block when sized by data (<= 128^2 pairs a task)

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)


DEFAULT_PARAMS = Params()
