"""Options, profiles and versions: plain Python, no data."""
