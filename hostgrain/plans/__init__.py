"""Whole jobs over the layers, deliveries, and the inputs made from the star schema."""
