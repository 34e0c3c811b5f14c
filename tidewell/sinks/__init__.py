"""Writers: staged replacement, append, profiles and records."""
