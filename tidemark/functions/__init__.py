"""Column-level functions: cleaners (P1-P10) and derived columns (D-1 ... D-9)."""
