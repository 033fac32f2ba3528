"""Generic DataFrame operators: contracts, keys, references, profiles, tests, drills."""
