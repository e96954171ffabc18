"""Operators for training-data pipelines: near-duplicates, token counts,
personal data, quality, chat formatting, language, decontamination, licences
and source mixing. Nothing else in the library imports this subpackage."""
