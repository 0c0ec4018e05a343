"""Operators that prepare text corpora for training, each in a module of its own; ``queries`` registers them."""
