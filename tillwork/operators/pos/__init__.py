"""Point-of-sale profiles: raw JSON records to refined tables and identities."""
