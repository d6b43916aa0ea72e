"""Whole plans: the feature stack, classification and the stage runner."""
