"""Operators for preparing training data: extraction, scans, duplicate removal, decontamination, language and packing."""
