"""Study steps: chains of operators from registers to an analysis table."""
