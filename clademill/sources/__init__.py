"""sources of clademill."""
