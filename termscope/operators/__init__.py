"""DataFrame-to-DataFrame steps; none collects rows."""
