"""End-to-end jobs composed of the other packages."""
