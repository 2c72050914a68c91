"""Operators for problems of large training-data collections; nothing outside this folder imports it."""
