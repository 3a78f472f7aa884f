"""Running jobs: consumers with progress, producers with results, health of a query."""
