"""Training-data operators: formatting, scans, cleaning, deduplication,
decontamination, mixing and archives. Nothing else in the library imports
this package."""
