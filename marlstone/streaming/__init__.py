"""Triggered (run, process, stop) streams between the layers."""
