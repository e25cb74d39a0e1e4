"""Silver and gold datasets, dashboard queries, and the batch pipeline."""
