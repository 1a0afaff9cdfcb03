"""Registered queries, the stand-in source views they read and their SQL twins."""
