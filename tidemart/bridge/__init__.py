"""The shared benchmark tables seen as the package's input tables."""
