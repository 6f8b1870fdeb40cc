"""Distributed operators: profile, clean, prepare, balance, split, evaluate."""
