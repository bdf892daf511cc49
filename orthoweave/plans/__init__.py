"""Jobs that combine the operators: frame plans, orthos, mosaics, recalibration, full runs."""
