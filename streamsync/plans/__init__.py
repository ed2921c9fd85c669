"""The registered queries, each next to its oracle SQL."""
