"""Models and clusterings on feature frames."""
