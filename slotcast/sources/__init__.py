"""Sources: the readings feed, files (CSV / JSON / Parquet) and payload parsing."""
