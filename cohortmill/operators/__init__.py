"""Operators: functions from DataFrame to DataFrame.

Row work is lazy.  Statistics that are looked up per row (quantiles, fill values, centres, limits)
are computed when the operator is called, because their size decides whether they may be broadcast;
fits and whatever else runs a job say so in their docstring.
"""
