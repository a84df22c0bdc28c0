"""stratum: layered (Bronze -> Silver -> Gold) warehouse operators on Spark DataFrames.

Every operator is a function from DataFrames (plus parameters such as ``run_ts``)
to a DataFrame; IO and table state live in :mod:`stratum.sources` and
:mod:`stratum.streaming`.
"""

__all__ = ["functions", "operators", "sources", "plans", "streaming"]
