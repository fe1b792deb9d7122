"""Reports (dashboard answers) and the registry of runnable queries."""
