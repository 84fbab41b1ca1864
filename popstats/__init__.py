"""popstats: population-style analytics as Spark DataFrame operators.

Every operator takes DataFrames plus keyword parameters and returns a lazy
DataFrame.  Nothing is collected inside an operator except bounded
parameters (k group names, a handful of model metrics).

Sub-packages:
  sources    -- delimited dump reader/parser, driver tables, synthetic people view
  functions  -- column-level helpers (date cleaning, age, bands, chi-square tail)
  operators  -- grouping, ranking, association, trend, sampling, models
  plans      -- the registered queries and their SQL oracles
  streaming  -- the stateless ingest operators applied to a streaming source
"""

from popstats.session import ensure_checkpoint_dir, get_session

__all__ = ["get_session", "ensure_checkpoint_dir"]
