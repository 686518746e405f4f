"""Set-based operators over market tables; each takes and returns DataFrames."""
