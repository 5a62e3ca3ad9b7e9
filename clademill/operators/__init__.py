"""operators of clademill."""
