"""Operators for preparing training text: de-duplication, similarity joins,
language identification, decontamination, extraction, fingerprints and token
files. Nothing else in the package imports this one."""
