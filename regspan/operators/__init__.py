"""Operators over whole registers.

Skew rule used throughout: a person may own a third of a register, so rows are
first reduced to at most one per person and calendar day (a partial aggregate
runs before that shuffle) and only the reduced rows meet in a per-person window
or array. Such a group is bounded by the calendar (about 36,500 days per
century). Where rows must be kept, the reduced result is joined back; adaptive
execution splits a skewed key there.
"""
