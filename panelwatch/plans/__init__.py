"""Whole computations: detectors, labelling runs, verification runs."""
