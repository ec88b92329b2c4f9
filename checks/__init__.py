"""Queries over tables derived from the driver's data, each with an independent SQL answer."""
