"""Operators of a large-scale training-data pipeline (dedup, decontamination,
quality, mixing, scoring, chat formatting, token output).  Nothing else in
the package imports this subpackage."""
