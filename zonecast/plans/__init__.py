"""The four composed jobs."""
