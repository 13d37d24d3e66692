"""Writers. Re-runs of the same run key replace their own output (dynamic partition
overwrite) instead of appending twice (SURVEY Q3, Q17)."""
