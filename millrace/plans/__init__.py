"""The distributor's layers built from the operators: silver, gold, measures, reports, monitoring."""
