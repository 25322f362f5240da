"""Readers of disclosure texts: what a passage states, as Catalyst expressions over a text column."""
