"""Where the rows come from."""
