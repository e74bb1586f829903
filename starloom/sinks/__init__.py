"""Where the tables go."""
