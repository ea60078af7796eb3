"""The ``pull_requests`` data source and the transports behind it."""
