"""Column-level helpers. Everything here builds Column expressions; nothing runs a job."""
