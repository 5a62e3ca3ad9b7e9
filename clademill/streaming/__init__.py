"""streaming of clademill."""
