"""Where events come from: files, topics, tables."""
