"""Registered queries: each operator run over whole tables, with its SQL twin."""
