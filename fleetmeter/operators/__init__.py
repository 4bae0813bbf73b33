"""Operators: decoded messages in, result tables out. All are lazy DataFrame plans."""
