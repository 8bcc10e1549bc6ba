"""Whole jobs, composed from the operators. One plan per job, however many periods it covers."""
