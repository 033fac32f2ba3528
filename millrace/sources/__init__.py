"""Reading raw files, publishing tables and views, landing audits, and the retail adapter."""
