"""The library's operators run over the TPC-H-like test tables."""
