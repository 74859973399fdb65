"""Structured Streaming jobs: ingest, daily health, cooldown, and the new-data refresh trigger."""
