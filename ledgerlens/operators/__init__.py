"""DataFrame operators that are not tied to one report."""
