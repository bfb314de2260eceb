"""Training-data operators: near-duplicates, filters, scoring, mixing, packing.

Each operator is a module of its own; ``queries`` holds the registered
``opN_<name>`` queries and their oracle SQL. Nothing outside this subpackage
imports it.
"""
