"""Silver and gold tables composed from the operators, and the backfill that writes them."""
