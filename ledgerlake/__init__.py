"""ledgerlake."""
