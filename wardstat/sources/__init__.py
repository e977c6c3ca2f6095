"""Reading and writing files and catalog tables."""
