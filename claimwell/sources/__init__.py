"""Inputs and outputs: claim files, code tables, arrivals, the lake's zones, audit tables."""
