"""Stage plans, configuration, command line and the query catalogue."""
