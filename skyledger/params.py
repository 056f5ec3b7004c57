"""Parameters of the registered queries, shared with their SQL oracles."""

SNAPSHOT_DATE = "2026-01-01"          # census snapshot_date literal
SNAPSHOT_CUTOFF = "1996-01-01"        # "past" snapshot: feed rows ingested before this
POSITION_T0 = "1998-08-03T00:00:00"   # first instant of the position grid (UTC)
POSITION_STEPS = 4
POSITION_STEP_SECONDS = 30
GLOBE_DIGITS = 3   # of degrees and km: what a globe display resolves
CENSUS_DATES = [f"{year}-{month}-01" for year in range(1995, 2002) for month in ("01", "07")]
STORM_MAX_LAG_HOURS = 72
