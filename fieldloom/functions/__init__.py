"""Column functions: band algebra, coordinates, tags."""
