"""DataFrame operators on pixels, vectors, catalogue items and samples."""
