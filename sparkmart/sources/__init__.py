"""Where raw tables come from."""
