"""Building blocks over DataFrames: joins, rollups, latest rows, maintenance and checks."""
