"""Jobs over files that arrive in the course of time."""
