"""File listing and log readers."""
