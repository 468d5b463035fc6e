"""Whole flows put together from functions and operators."""
