"""DataFrame operators over record logs, record sets, progress tables and put requests."""
