"""Relational and statistical steps, each a pure function DataFrame -> DataFrame.

A busy uid may hold a large share of all lines, so no step opens a window over lines.
Lines are first aggregated to one row per (uid, day), with map-side partial sums; windows
run over those rows only, which a calendar bounds; results are joined back on (uid, day).
"""
