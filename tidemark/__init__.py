"""Event analytics as Spark jobs: envelopes, windows, lake, features, point-in-time reads."""
