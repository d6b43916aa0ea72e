"""Readers and writers: TIFF, GeoPackage, PNG, sidecars, scene folders."""
