"""DataFrame operators: deduplication, lookups, reference flags, checks, profiles."""
