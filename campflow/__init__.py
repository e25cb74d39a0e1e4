"""Campaign web analytics as Spark jobs: raw events in, campaign performance tables and dashboard answers out."""
