"""The engine's work expressed over the given star-schema tables, with SQL to check it."""
