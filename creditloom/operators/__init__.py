"""DataFrame-to-DataFrame operators; columns and thresholds are parameters, so each works with `.transform`."""
