"""Star tables, marts and the jobs that load them."""
