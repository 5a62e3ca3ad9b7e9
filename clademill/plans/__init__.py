"""plans of clademill."""
