"""Set-based writes, surrogate keys, constraint checks, audits."""
