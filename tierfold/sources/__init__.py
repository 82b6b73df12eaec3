"""Where data comes from and goes to: shared folders, JSON landing zones, tables."""
