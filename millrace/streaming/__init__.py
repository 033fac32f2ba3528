"""File streams into bronze."""
