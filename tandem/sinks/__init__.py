"""Writers for predictions, truth files and evaluation tables."""
