"""Reusable Column expressions. Everything here compiles to Catalyst expressions
(whole-stage codegen friendly); nothing here is a Python UDF."""
