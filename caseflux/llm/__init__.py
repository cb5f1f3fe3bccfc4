"""Operators for preparing training text: sanitising, decontamination, extraction, dedup, packing and scoring."""
