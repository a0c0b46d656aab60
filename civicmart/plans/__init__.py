"""Plans that run actions: audit refresh, gates, the batch job."""
