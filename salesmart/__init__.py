"""Point-of-sale analytics as DataFrame transformations."""
