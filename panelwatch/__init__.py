"""Event detection, verification and labelling over firm-by-month panels, on Spark."""
