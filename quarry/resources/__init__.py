"""Data files shipped with the package (the fixed stop-word list)."""
