"""Where events go: warm, hot and cold tables, journal, dead letters; upkeep of those tables."""
