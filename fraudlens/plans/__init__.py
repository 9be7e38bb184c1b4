"""End-to-end jobs (feature job, cleanse/profile, training) and the query registry."""
