"""functions of clademill."""
