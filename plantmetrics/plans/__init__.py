"""Plans: how the operators are wired and written (model graph, sinks, refresh)."""
