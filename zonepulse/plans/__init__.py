"""Whole stages of the study, put together from the operators."""
