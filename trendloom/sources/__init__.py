"""Reading day files and dictionaries, landing them, and the versioned tables behind."""
