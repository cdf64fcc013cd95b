"""Reading landed files and writing result tables."""
