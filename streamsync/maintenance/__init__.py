"""Table maintenance (M1-M4)."""
