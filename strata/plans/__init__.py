"""Configuration, the group dimension and whole runs."""
