"""DataFrame -> DataFrame operators (lazy; nothing here triggers a job)."""
