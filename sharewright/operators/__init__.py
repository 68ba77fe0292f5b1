"""Table operators. Each takes and returns DataFrames; those that need per-key totals stage them first."""
