"""Where results go: files, catalog tables and views."""
