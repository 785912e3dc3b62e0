"""Dimension, fact, mart and report builders."""
