"""DataFrame operators of the staging, silver and gold layers."""
