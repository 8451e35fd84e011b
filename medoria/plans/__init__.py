"""Dimensions, facts, questions and whole runs, composed from the operators."""
